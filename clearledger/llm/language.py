"""Language ID by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, drawn from its code point, whatever the script. An n-gram's vector binds its
letters' vectors, each permuted (rotated) by its place, by multiplying them; a text's vector bundles (adds) the vectors of its
n-grams, and a language's prototype is the bundle of its learned texts' unit vectors. A text gets the
language whose prototype is nearest by cosine.

Everything that is not a letter counts as a gap between words. Null texts and texts without a letter are `und` with score 0. Equally near
prototypes: the first language in code-point order. Repeated rows get equal results and each teaches as a text of its own. Empty tables, or no row to learn from:
every text is `und`. Texts may be of any length: n-grams are counted in blocks. Only the named columns are read; the result is the column `_lid`, which docs must not have.

Prototypes are learned from a bounded sample of about per_lang texts a language, chosen by a hash of the id. What reaches the driver is
dim numbers a language, so it is bounded by the list of languages.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialise

GRAM, BLOCK, BITS = 3, 1 << 20, 21
#: Languages up to which their shares are broadcast.
LANGUAGES = 10_000
#: Vectors of n-grams and of letters that a worker keeps.
KEPT_GRAMS, KEPT_LETTERS = 32_768, 4_096


class Profile:
    """Counts n-grams of texts and bundles them; keeps the vectors of n-grams and letters met, up to a limit."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        self.low = np.array([chr(c).isalpha() for c in range(0x3000)])
        self.letters: dict[int, np.ndarray] = {}
        self.codes, self.vectors = np.zeros(0, dtype=np.int64), np.zeros((0, dim), dtype=np.float32)

    def symbols(self, text: str) -> np.ndarray:
        """The code points of letters, 0 for everything else."""
        cps = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        letter = self.low[np.minimum(cps, len(self.low) - 1)]
        high = cps >= len(self.low)
        if high.any():
            met, back = np.unique(cps[high], return_inverse=True)
            letter[high] = np.array([chr(c).isalpha() for c in met.tolist()])[back]
        return np.where(letter, cps, 0)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """n-gram codes of the text and how often each occurs; nothing if it has no letter."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        tail, letter, text = np.zeros(1, dtype=np.int64), False, text or ""
        for at in range(0, len(text), BLOCK):
            s = np.concatenate([tail, self.symbols(text[at : at + BLOCK]), np.zeros(int(at + BLOCK >= len(text)), dtype=np.int64)])
            s = s[np.r_[True, (s[1:] > 0) | (s[:-1] > 0)]]  # one gap between words
            letter = letter or bool(s.any())
            found.append(np.unique((s[:-2] << 2 * BITS) | (s[1:-1] << BITS) | s[2:], return_counts=True))
            tail = s[-2:]
        if not letter:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        if len(found) == 1:
            return found[0]
        codes, back = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
        return codes, np.bincount(back, weights=np.concatenate([n for _, n in found]))

    def letter(self, cp: int) -> np.ndarray:
        if cp not in self.letters:
            if len(self.letters) >= KEPT_LETTERS:
                self.letters.clear()
            self.letters[cp] = np.random.default_rng([self.seed, cp]).choice(np.array([-1, 1], dtype=np.int8), size=self.dim)
        return self.letters[cp]

    def gram_vectors(self, codes: np.ndarray) -> np.ndarray:
        """The bound vectors of n-gram codes."""
        out = np.ones((len(codes), self.dim), dtype=np.int8)
        for place in range(GRAM):
            shift = GRAM - 1 - place
            met, back = np.unique((codes >> shift * BITS) & ((1 << BITS) - 1), return_inverse=True)
            out *= np.roll(np.stack([self.letter(c) for c in met.tolist()]), shift, axis=1)[back]
        return out

    def kept(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of at most KEPT_GRAMS sorted codes, as floats."""
        new = codes[~np.isin(codes, self.codes, assume_unique=True)]
        if len(new):
            if len(self.codes) + len(new) > KEPT_GRAMS:
                self.codes, self.vectors, new = self.codes[:0], self.vectors[:0], codes
            every = np.concatenate([self.codes, new])
            order = np.argsort(every, kind="stable")
            self.codes, self.vectors = every[order], np.concatenate([self.vectors, self.gram_vectors(new).astype(np.float32)])[order]
        return self.vectors[np.searchsorted(self.codes, codes)]

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: its bundled vector scaled to length 1, zeros if it has no letter."""
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for at in range(0, len(texts), 64):
            counted = [self.counts(t) for t in texts[at : at + 64]]
            codes = np.unique(np.concatenate([c for c, _ in counted]))
            if not len(codes):
                continue
            weights = np.zeros((len(counted), len(codes)), dtype=np.float32)
            for i, (c, n) in enumerate(counted):
                weights[i, np.searchsorted(codes, c)] = n
            for k in range(0, len(codes), KEPT_GRAMS):
                out[at : at + len(counted)] += weights[:, k : k + KEPT_GRAMS] @ self.kept(codes[k : k + KEPT_GRAMS])
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)


def _sample(docs: DataFrame, id_col: str, lang: str, learn: Column, per_lang: int) -> DataFrame:
    """About per_lang rows of each language: those whose id hash is below the language's share."""
    known = docs.where(learn & F.col(lang).isNotNull())
    share = known.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("_n"))
    share = materialise(share, "languages")
    few = share.limit(LANGUAGES + 1).count() <= LANGUAGES  # else Spark joins as it sees fit
    return known.join(F.broadcast(share) if few else share, F.col(lang) == F.col("_lang")).where(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) * F.col("_n") < F.lit(1_000_003 * per_lang)
    )


def prototypes(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 2000, dim: int = 1024, seed: int = 7) -> tuple[list[str], np.ndarray]:
    """(languages, a prototype row for each). Bundles are added up by Spark, dim numbers a language."""
    taught = _sample(docs, id_col, lang, learn, per_lang).select(F.col(text).cast("string").alias("text"), F.col("_lang").alias("lang"))
    def add(batches):
        p, sums = Profile(dim, seed), {}
        for b in batches:
            for name, rows in b.groupby("lang"):
                sums[name] = sums.get(name, 0.0) + p.bundle(list(rows["text"])).sum(axis=0, dtype=np.float64)
        for name, v in sums.items():
            yield pd.DataFrame({"lang": name, "at": np.arange(dim), "v": v})

    added = taught.mapInPandas(add, "lang string, at int, v double").groupBy("lang", "at").agg(F.sum("v").alias("v"))
    rows = added.toPandas()  # dim numbers a language
    langs = sorted(rows["lang"].unique())
    out = np.zeros((len(langs), dim), dtype=np.float32)
    for i, name in enumerate(langs):
        own = rows[rows["lang"] == name]
        out[i, own["at"].to_numpy()] = np.round(own["v"].to_numpy(), 6)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return langs, out / np.where(norm > 0, norm, 1)


def identifier(langs: list[str], protos: np.ndarray, seed: int = 7):
    """A column function: text -> struct(lang_pred, score); score is the cosine, cut at 0."""
    kept: dict[str, Profile] = {}

    @pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        p = kept.setdefault("p", Profile(protos.shape[1], seed))
        unit = p.bundle(list(texts))
        if not langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0})
        cos = unit @ protos.T
        best = cos.argmax(axis=1)
        any_letter = unit.any(axis=1)
        return pd.DataFrame({
            "lang_pred": [langs[b] if a else "und" for a, b in zip(any_letter, best, strict=True)],
            "score": np.where(any_letter, np.clip(cos[np.arange(len(best)), best].astype(float), 0, 1), 0.0),
        })

    return run


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", **how) -> DataFrame:
    """docs with lang_pred and score in a struct column _lid; only rows where learn holds teach."""
    return docs.withColumn("_lid", identifier(*prototypes(docs, learn, id_col, text, lang, **how), seed=how.get("seed", 7))(F.col(text).cast("string")))
