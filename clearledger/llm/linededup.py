"""Line dedup by a log-template tree, in DataFrame functions alone.

The tree has a fixed depth. A line's path starts with its number of tokens and its LEAD leading tokens, with every token that holds
a digit generalised. At a node, the commonest token of each place, counted in documents, makes the node's pattern. Lines with at
least ALIKE percent of the pattern's tokens, and with half of those after the leading ones, are one template there, whatever the places in
which they differ: those places are its variable fields. The other lines go one level down by their next token (tokens of fewer
than min_docs documents share the node of variable tokens), until the last level; a line that no pattern took is a
template of its own. A line that occurs in min_docs documents or more recurs, numbers aside; it is dropped everywhere but in the document with
the smallest id, which stands for it. A template with variable fields recurs, and goes but for one line, where template_docs documents or more
hold it; in fewer, each of its lines counts for itself. Lines of a template may state different things: a caller who would rather keep those
leaves template_docs at TEMPLATE_DOCS. The query and the pipeline give MIN_DOCS, so every template that recurs goes there.

Lines travel as two hashes, path and whole line, so only lines of paths that several documents have are read as text again.
Counts are partial sums before each shuffle, and the joins that meet lines with templates or patterns are salted, so a line that a third of
all documents share is spread. A template's lines agree in two independent 64-bit hashes, or were compared token by token with its pattern.

Null texts stay null and texts without a recurring line stay as they are, byte for byte. Lines of fewer than SHORT tokens are never
dropped. Rows with the same id and text are one document; rows with the same id and other text are others. A null id counts as larger than
all others. Equally common tokens of a place: the larger string is the pattern's. An empty table gives an empty result. Lines may be of any
length. Columns of docs may have any names but those that begin with `_line_`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

LEAD, DEPTH, SHORT, ALIKE, MIN_DOCS, TEMPLATE_DOCS = 3, 3, 3, 70, 3, 30
#: Parts of a join key of lines; lines of a node that one task compares with its pattern.
SALT, MEMBERS = 8, 20_000
_BLANK = r"[\x20\x09\x0B-\x0D]+"
#: A token with a digit, found from its start without going back.
_NUMBERED = r"(?<![^\x20])[^\x200-9]*+[0-9][^\x20]*+"
_LAST = 9_223_372_036_854_775_807


def _identity(docs: DataFrame, id_col: str, text: str) -> list[Column]:
    """A document's name: its id and a hash of its text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(F.col(id_col).isNull(), F.col(text).cast("string")).alias("dk")]


def _exploded(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc, dk, line, body): the lines of each text, blanks at the ends removed and others single, tokens with digits generalised."""
    body = F.col(text).cast("string")
    lines = docs.where(body.isNotNull()).select(*_identity(docs, id_col, text), F.posexplode(F.split(body, "\n")).alias("line", "raw"))
    trimmed = lines.withColumn("raw", F.btrim("raw", F.lit(" \t\x0b\x0c\r")))
    uneven = reduce(Column.__or__, [F.col("raw").contains(x) for x in ("  ", "\t", "\x0b", "\x0c", "\r")])
    single = F.when(uneven, F.regexp_replace("raw", _BLANK, " ")).otherwise(F.col("raw"))
    return trimmed.withColumn("body", single).select("doc", "dk", "line", F.when(F.col("body").rlike("[0-9]"), F.regexp_replace("body", _NUMBERED, "<*>")).otherwise(F.col("body")).alias("body"))


def _hashed(lines: DataFrame) -> DataFrame:
    """(doc, dk, line, node, whole): the hash of each line's path, null for short lines, and of the line itself."""
    n = F.length("body") - F.length(F.replace("body", F.lit(" "), F.lit(""))) + 1
    return lines.select("doc", "dk", "line", F.when(n >= SHORT, F.xxhash64(n, F.substring_index("body", " ", LEAD))).alias("node"), F.xxhash64("body").alias("whole"))


def _kinds(lines: DataFrame) -> DataFrame:
    """(node, whole, docs, first): each distinct line, its number of documents and its place in the smallest of them."""
    once = lines.groupBy("node", "whole", "doc", "dk").agg(F.min("line").alias("line"))
    return once.groupBy("node", "whole").agg(F.count("*").alias("docs"), F.min(F.struct("doc", "dk", "line")).alias("first"))


def _shared(kinds: DataFrame, min_docs: int) -> DataFrame:
    """(node, members, parts): nodes that hold several kinds of lines and enough documents to have a template."""
    nodes = kinds.groupBy("node").agg(F.count("*").alias("members"), F.sum("docs").alias("held"))
    return nodes.where((F.col("members") > 1) & (F.col("held") >= min_docs)).select("node", "members", F.ceil(F.col("members") / MEMBERS).cast("int").alias("parts"))


def _level(kinds: DataFrame, lead: int, min_docs: int) -> DataFrame:
    """(node, origin, whole, docs, tokens, taken, next): which kinds of lines their node's pattern takes, and the node one level down.

    kinds: (node, origin, whole, docs, tokens). Kinds of nodes that cannot have a template are left out.
    """
    shared = _shared(kinds, min_docs)
    salted = kinds.withColumn("salt", F.pmod(F.xxhash64("whole"), F.lit(SALT)).cast("int"))
    live = salted.join(shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), ["node", "salt"]).drop("salt")
    seen = live.select("node", "docs", F.posexplode("tokens").alias("at", "token")).groupBy("node", "at", "token").agg(F.sum("docs").alias("held"))
    best = seen.groupBy("node", "at").agg(F.max(F.struct("held", "token")).alias("best"))
    pattern = best.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "best.token"))), lambda x: x["token"]).alias("pattern"))
    pattern = pattern.join(shared, "node").select("node", "pattern", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    following = seen.where(F.col("at") == lead).select("node", F.col("token").alias("following"), "held")
    met = live.withColumn("part", F.pmod(F.xxhash64("whole"), F.col("parts")).cast("int")).join(pattern, ["node", "part"])
    n = F.size("tokens")
    same = F.size(F.filter(F.zip_with("tokens", "pattern", lambda a, b: a == b), lambda x: x))
    marked = met.select("node", "origin", "whole", "docs", "tokens", n.alias("n"), same.alias("same"), F.get("tokens", F.lit(lead)).alias("following"))
    marked = marked.withColumn("taken", (100 * F.col("same") >= ALIKE * F.col("n")) & (2 * (F.col("same") - LEAD) >= F.col("n") - LEAD))
    often = following.where(F.col("held") >= min_docs).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    down = marked.withColumn("part", F.pmod(F.xxhash64("whole"), F.lit(SALT)).cast("int")).join(often, ["node", "following", "part"], "left")
    child = F.xxhash64("node", F.when(F.col("held").isNotNull(), F.col("following")))
    return down.select("node", "origin", "whole", "docs", "tokens", "taken", child.alias("next"))


def templates(docs: DataFrame, lines: DataFrame, id_col: str, text: str, min_docs: int = MIN_DOCS, template_docs: int = TEMPLATE_DOCS) -> DataFrame:
    """(node, whole, first, alike): the kinds of lines that recur, and the document that keeps each or its template (alike). lines: as _hashed gives them."""
    kinds = materialise(_kinds(lines), "kinds")
    several = kinds.join(_shared(kinds, min_docs).select("node"), "node", "left_semi").select("node", "whole", "docs", "first.*")
    read = _exploded(docs, id_col, text).join(several.hint("shuffle_hash"), ["doc", "dk", "line"]).dropDuplicates(["node", "whole"])
    rest = materialise(read.select("node", F.col("node").alias("origin"), "whole", "docs", F.split("body", " ").alias("tokens")), "tokens")
    found = []
    for lead in range(LEAD, LEAD + DEPTH):
        level = materialise(_level(rest, lead, min_docs), "level")
        found.append(level.where("taken").select(F.col("origin").alias("node"), "whole", F.struct(F.lit(lead).alias("lead"), "node").alias("template")))
        rest = level.where("not taken").select(F.col("next").alias("node"), "origin", "whole", "docs", "tokens")
    taken = reduce(DataFrame.unionByName, found)
    salt = F.pmod(F.xxhash64("doc", "dk"), F.lit(SALT)).cast("int")
    spread = taken.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    held = lines.withColumn("salt", salt).join(spread, ["node", "whole", "salt"]).select("template", "doc", "dk").distinct()
    recurring = held.groupBy("template").agg(F.count("*").alias("docs"), F.min(F.struct("doc", "dk")).alias("first")).where(F.col("docs") >= template_docs)
    parts = recurring.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    joint = taken.withColumn("salt", F.pmod(F.xxhash64("whole"), F.lit(SALT)).cast("int")).join(parts, ["template", "salt"]).select("node", "whole", "first.doc", "first.dk")
    joint = materialise(joint, "templates")
    own = kinds.where(F.col("docs") >= min_docs).join(joint, ["node", "whole"], "left_anti").select("node", "whole", "first.doc", "first.dk")
    both = own.withColumn("alike", F.lit(False)).unionByName(joint.withColumn("alike", F.lit(True)))
    return both.select("node", "whole", F.struct("doc", "dk").alias("first"), "alike")


def dropped_lines(lines: DataFrame, recurring: DataFrame) -> DataFrame:
    """(doc, dk, dropped, alike): the places of the lines that each document loses, in order, and how many of them go by a template."""
    salt = F.pmod(F.xxhash64("doc", "dk"), F.lit(SALT)).cast("int")
    spread = recurring.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    hit = lines.withColumn("salt", salt).join(spread, ["node", "whole", "salt"]).where(F.struct("doc", "dk") != F.col("first"))
    return hit.groupBy("doc", "dk").agg(F.array_sort(F.collect_set("line")).alias("dropped"), F.countDistinct(F.when(F.col("alike"), F.col("line"))).alias("alike"))


def _without(lines: Column, dropped: Column) -> Column:
    """The lines but the dropped places, as stretches between two of those."""
    starts = F.concat(F.array(F.lit(-1)), dropped)
    stretches = lambda held: F.zip_with(starts, F.concat(dropped, F.array(F.size(held))), lambda a, b: F.slice(held, a + 2, b - a - 1))
    return F.element_at(F.transform(F.array(lines), lambda held: F.array_join(F.flatten(stretches(held)), "\n")), 1)  # lines are split once


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, info: str | None = None, template_docs: int = TEMPLATE_DOCS) -> DataFrame:
    """docs with the recurring lines taken out of `text`; info names a struct column with n_lines, n_dropped and n_alike (of these, by a template)."""
    lines = materialise(_hashed(_exploded(docs, id_col, text)), "lines").where("node is not null")  # a filter before would compute all of it twice
    lost = dropped_lines(lines, templates(docs, lines, id_col, text, min_docs, template_docs)).withColumnsRenamed({"doc": "_line_doc", "dk": "_line_dk", "dropped": "_line_dropped", "alike": "_line_alike"})
    doc, dk = _identity(docs, id_col, text)
    joined = docs.join(lost, (doc == F.col("_line_doc")) & (dk == F.col("_line_dk")), "left")
    body, gone = F.col(text).cast("string"), F.col("_line_dropped")
    left = F.when(gone.isNull(), body).otherwise(_without(F.split(body, "\n"), gone))
    count = F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1
    more = [] if info is None else [F.struct(F.coalesce(count, F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("_line_alike", F.lit(0)).cast("long").alias("n_alike")).alias(info)]
    return joined.select(*[left.alias(c) if c == text else F.col(c) for c in docs.columns], *more)


def _level_sql(at: int) -> str:
    """A level of the tree: k{at} holds the kinds of lines that came down to it."""
    lead = LEAD + at
    return f"""
s{at} AS (SELECT node FROM k{at} GROUP BY node HAVING COUNT(*) > 1 AND SUM(docs) >= {MIN_DOCS}),
t{at} AS (SELECT node, i AS place, tokens[i] AS token, SUM(docs) AS held FROM (SELECT node, docs, tokens, UNNEST(RANGE(1, LEN(tokens) + 1)) AS i FROM k{at} SEMI JOIN s{at} USING (node)) GROUP BY ALL),
b{at} AS (SELECT node, LIST(token ORDER BY place) AS pattern FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY node, place ORDER BY held DESC, token DESC) AS rank FROM t{at}) WHERE rank = 1 GROUP BY node),
m{at} AS (SELECT k.*, LEN(LIST_FILTER(RANGE(1, LEN(tokens) + 1), LAMBDA i: tokens[i] = pattern[i])) AS same FROM k{at} k JOIN b{at} USING (node)),
x{at} AS (SELECT m.*, 100 * same >= {ALIKE} * LEN(tokens) AND 2 * (same - {LEAD}) >= LEN(tokens) - {LEAD} AS taken, CASE WHEN t.held >= {MIN_DOCS} THEN t.token END AS following
  FROM m{at} m LEFT JOIN t{at} t ON t.node = m.node AND t.place = {lead + 1} AND t.token = m.tokens[{lead + 1}]),
k{at + 1} AS (SELECT node || CASE WHEN following IS NULL THEN chr(1) ELSE ' ' || following END AS node, whole, docs, tokens FROM x{at} WHERE NOT taken),"""


LINES_SQL = rf"""
WITH l AS (SELECT doc_id, UNNEST(RANGE(1, LEN(STRING_SPLIT(text, CHR(10))) + 1)) AS line, UNNEST(STRING_SPLIT(text, CHR(10))) AS body FROM documents),
t AS (SELECT doc_id, line, LIST_TRANSFORM(REGEXP_EXTRACT_ALL(body, '[^\x20\x09-\x0D]+'), LAMBDA x: CASE WHEN REGEXP_MATCHES(x, '[0-9]') THEN '<*>' ELSE x END) AS tokens FROM l),
w AS (SELECT doc_id, line, tokens, ARRAY_TO_STRING(tokens, ' ') AS whole FROM t WHERE LEN(tokens) >= {SHORT}),
k0 AS (SELECT LEN(tokens) || ' ' || ARRAY_TO_STRING(tokens[1:{LEAD}], ' ') AS node, whole, COUNT(DISTINCT doc_id) AS docs, ANY_VALUE(tokens) AS tokens FROM w GROUP BY whole, node),
{"".join(_level_sql(i) for i in range(DEPTH))}
p AS (SELECT whole, {LEAD} || node AS template FROM x0 WHERE taken {"".join(f" UNION ALL SELECT whole, '{LEAD + i} ' || node FROM x{i} WHERE taken" for i in range(1, DEPTH))}),
a AS (SELECT doc_id, line, COALESCE(template, 'own ' || whole) AS template FROM w LEFT JOIN p USING (whole)),
f AS (SELECT template, MIN(doc_id) AS first FROM a GROUP BY template HAVING COUNT(DISTINCT doc_id) >= {MIN_DOCS}),
g AS (SELECT DISTINCT doc_id, line FROM a JOIN f USING (template) WHERE doc_id <> first)
SELECT l.doc_id, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(COUNT(g.line) AS BIGINT) AS n_dropped,
  COALESCE(STRING_AGG(body, CHR(10) ORDER BY l.line) FILTER (g.line IS NULL), '') AS text
FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id
"""
