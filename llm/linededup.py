"""Line dedup with a log-template tree, in DataFrame operations only.

Lines are parsed by a tree of fixed depth: the first level is the number of tokens, the
next levels are the leading tokens, with tokens that hold a digit generalised to ``<*>``.
In a leaf, places with much variety are variable fields: a token is one if it is several
times rarer at its place than ``constant_share`` of the line's tokens are at theirs.  Only
ratios decide, so more rows of the same kind give the same templates.  The line with its
fields generalised is its template.  A template recurs if it occurs in two documents; one
of fewer than ``long_line`` tokens, which may be a phrase that many authors write, has to
occur in ``min_docs``.  Its first occurrence stays, all others are dropped.

Texts are never shuffled line by line: only hashes of lines and trees are, and the tokens
of lines in leaves that several forms share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import written

FIELD = "<*>"
LEADING = 3
MIN_DOCS = 5
LONG_LINE = 10
CONSTANT_SHARE = 0.8
VARIETY = 4  # a field's token is more than so many times rarer than the line's constant ones
FILTER_BITS = range(17, 26)  # of the bitmap of leaves, as powers of two


def _bar(tokens: Column, min_docs: int, long_line: int) -> Column:
    """Number of documents from which on a line of so many tokens recurs."""
    return F.when(tokens < long_line, min_docs).otherwise(min(2, min_docs))


def _spare(constant_share: float) -> int:
    """Percent of a line's tokens that may be fields."""
    return round(100 * (1 - constant_share))


def _clean(line: Column) -> Column:
    """One space between tokens, none around them; tokens with a digit generalised."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(line, "[\t\r\x0b\x0c]", " "), " {2,}", " "))
    # Most lines need nothing of this: one look tells.
    return F.when(
        line.rlike("[0-9\t\r\x0b\x0c]|  |^ | $"),
        F.regexp_replace(plain, "[^ ]*[0-9][^ ]*", FIELD),
    ).otherwise(line)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, pos, tokens, leaf, literal, line) for every line that holds a token.

    ``doc`` tells documents of one doc_id apart; ``leaf`` and ``literal`` are hashes.
    """
    lines = docs.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "raw")
    )
    line = lines.select("doc_id", "doc", "pos", _clean(F.col("raw")).alias("line")).where("line <> ''")
    tokens = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return line.select(
        "doc_id", "doc", "pos", tokens.alias("tokens"),
        F.xxhash64(F.substring_index("line", " ", LEADING)).alias("leaf"), F.xxhash64("line").alias("literal"), "line",
    )


def _maybe(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """``lines`` without most of those in other leaves than ``leaves``; never drops one of these.

    A bitmap stands for the leaves: eight bits for each, 2 ** 25 bits (524,288 words) at
    most, so it can be broadcast whatever their number; a join decides about what it lets pass.
    """
    bits = min(max((8 * leaves.count()).bit_length(), FILTER_BITS.start), FILTER_BITS.stop - 1)
    at = F.pmod(F.xxhash64("tokens", "leaf"), F.lit(1 << bits))
    word, bit = F.shiftright(at, 6), (at % 64).cast("int")
    bitmap = leaves.select(
        word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit")
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    marked = lines.join(F.broadcast(bitmap), word == F.col("word"))
    return marked.where(F.getbit("bits", bit) == 1).select(lines.columns)


def dropped_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    constant_share: float = CONSTANT_SHARE,
    long_line: int = LONG_LINE,
) -> DataFrame:
    """(doc_id, doc, drop: array of line numbers) for the documents that lose lines."""
    bar = _bar(F.col("tokens"), min_docs, long_line)
    lines = written(_lines(docs), "lines", compression="zstd")
    slim = lines.drop("line")
    leaf = ["tokens", "leaf"]
    # Leaves with fewer lines than documents are asked for hold nothing that recurs.
    reached = written(slim.groupBy(*leaf).count().where(F.col("count") >= bar).select(*leaf), "reached")
    near = written(_maybe(slim, reached).join(reached, leaf), "near")
    per_doc = near.select(*leaf, "literal", "doc_id", "doc").distinct()
    literals = written(per_doc.groupBy(*leaf, "literal").agg(F.count("*").alias("n")), "literals")
    busy = (
        literals.groupBy(*leaf).agg(F.sum("n").alias("reach"), F.count("*").alias("forms"))
        .where(F.col("reach") >= bar)
    )
    wanted = written(literals.join(busy, leaf), "leaves")

    # Leaves with one form only are templates already, as are those too small for a field; in the others fields are found.
    mixed = wanted.where((F.col("forms") > 1) & (F.col("reach") > VARIETY) & (F.col("tokens") > LEADING))
    line_key = [*leaf, "literal"]
    texts = (
        _maybe(lines, mixed.select(*leaf).distinct()).select(*line_key, "line").distinct()
        .join(mixed.select(*line_key, "n"), line_key)
    )
    tokens = written(
        texts.select(*line_key, "n", F.posexplode(F.split("line", " ")).alias("at", "token"))
        .withColumn("token", F.xxhash64("token")),
        "tokens",
    )
    support = written(tokens.groupBy(*leaf, "at", "token").agg(F.sum("n").alias("support")), "support")
    # A template is known by the hash of its tokens' hashes in order.
    places = (
        tokens.join(support, [*leaf, "at", "token"])
        .groupBy(*line_key)
        .agg(F.sort_array(F.collect_list(F.struct("at", "token", "support"))).alias("places"))
    )
    usual = F.get(F.sort_array("places.support"), (F.col("tokens") * _spare(constant_share) / 100).cast("int"))
    form = F.zip_with(
        "places",
        F.array_repeat(usual, F.size("places")),
        lambda place, most: F.when(VARIETY * place["support"] < most, F.xxhash64(F.lit(FIELD))).otherwise(place["token"]),
    )
    templates = written(
        wanted.select(*line_key).join(places.select(*line_key, F.xxhash64(form).alias("form")), line_key, "left")
        .select(*line_key, F.coalesce("form", "literal").alias("form")),
        "templates",
    )
    template = [*leaf, "form"]
    hits = written(near.join(templates, line_key).select(*template, "doc_id", "doc", "pos"), "hits")
    place = F.struct("doc_id", "doc", "pos")
    recurring = written(
        hits.select(*template, "doc_id", "doc").distinct()
        .groupBy(*template).agg(F.count("*").alias("docs")).where(F.col("docs") >= bar)
        .join(hits.groupBy(*template).agg(F.min(place).alias("first")), template),
        "recurring",
    )
    return (
        hits.join(recurring, template).where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "doc").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    )


def dedup_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    constant_share: float = CONSTANT_SHARE,
    long_line: int = LONG_LINE,
) -> DataFrame:
    """``docs`` with shorter texts, and n_lines and n_dropped (longs).

    A template's first occurrence is the one with the smallest doc_id (null first), then
    text, then line.  Blank lines and lines of other templates stay as they are, in order.
    A document that loses all of its lines has an empty text; none disappears.  A null
    text stays null, with no lines.  Rows that repeat a (doc_id, text) count as one
    document and get the same result.  Texts of any length are taken whole, in time linear
    in their lines.  Columns of ``docs`` other than text pass through.
    """
    drops = dropped_lines(docs.select("doc_id", "text"), min_docs, constant_share, long_line)
    # Prefixed names: whatever columns docs has, none clashes.
    keyed = docs.withColumn("__doc", F.xxhash64("doc_id", "text"))
    found = drops.select(
        F.col("doc").alias("__doc"), F.col("doc_id").alias("__doc_id"), F.col("drop").alias("__drop")
    )
    # Drops grow with the documents: merged, never broadcast.
    joined = keyed.join(
        found.hint("merge"),
        (keyed["__doc"] == found["__doc"]) & keyed["doc_id"].eqNullSafe(found["__doc_id"]),
        "left",
    )
    # The lines between two dropped ones stay; both columns are read twice, so neither is computed within the lambda.
    parts = joined.withColumn("__lines", F.split("text", "\n"))
    minus = F.array(F.lit(-1))
    rest = F.zip_with(
        F.concat(minus, "__drop"),
        F.concat("__drop", F.array(F.size("__lines"))),
        lambda before, after: F.slice("__lines", before + 2, after - before - 1),
    )
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(rest), "\n"))
    others = [F.col(f"`{c}`") if c != "text" else text.alias("text") for c in docs.columns]
    others = [c for c, n in zip(others, docs.columns) if n not in ("n_lines", "n_dropped")]
    return parts.select(
        *others,
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def sql(min_docs: int = MIN_DOCS, constant_share: float = CONSTANT_SHARE, long_line: int = LONG_LINE) -> str:
    """The same over the table ``documents`` in SQL: doc_id, text, n_lines, n_dropped."""
    def bar(tokens: str) -> str:
        return f"CASE WHEN {tokens} < {long_line} THEN {min_docs} ELSE {min(2, min_docs)} END"

    return f"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (
  SELECT r, doc_id, text, i - 1 AS pos, string_split(text, chr(10))[i] AS raw
  FROM raw, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i)),
plain AS (
  SELECT r, doc_id, text, pos, raw,
    trim(regexp_replace(translate(raw, chr(9) || chr(13) || chr(11) || chr(12), '    '), ' {{2,}}', ' ', 'g'), ' ') AS p
  FROM lines),
cleaned AS (
  SELECT r, doc_id, text, pos, raw, regexp_replace(p, '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS line
  FROM plain),
parsed AS (
  SELECT *, string_split(line, ' ') AS toks, len(string_split(line, ' ')) AS n_tok,
    array_to_string(string_split(line, ' ')[1:{LEADING}], ' ') AS lead
  FROM cleaned WHERE line <> ''),
forms AS (
  SELECT n_tok, lead, line, any_value(toks) AS toks, count(DISTINCT (doc_id, text)) AS n
  FROM parsed GROUP BY n_tok, lead, line),
busy AS (
  SELECT n_tok, lead, count(*) AS k FROM forms GROUP BY n_tok, lead HAVING sum(n) >= {bar("n_tok")}),
wanted AS (SELECT f.*, b.k FROM forms f JOIN busy b USING (n_tok, lead)),
tokens AS (
  SELECT n_tok, lead, line, n, i AS spot, toks[i] AS token
  FROM wanted, LATERAL (SELECT unnest(range(1, n_tok + 1)) AS i)
  WHERE k > 1 AND n_tok > {LEADING}),
support AS (
  SELECT n_tok, lead, spot, token, sum(n) AS s FROM tokens GROUP BY n_tok, lead, spot, token),
placed AS (SELECT * FROM tokens JOIN support USING (n_tok, lead, spot, token)),
usual AS (
  SELECT line, list_sort(list(s))[any_value(n_tok) * {_spare(constant_share)} // 100 + 1] AS most FROM placed GROUP BY line),
general AS (
  SELECT line, string_agg(CASE WHEN {VARIETY} * s < most THEN '{FIELD}' ELSE token END, ' ' ORDER BY spot) AS template
  FROM placed JOIN usual USING (line) GROUP BY line),
hits AS (
  SELECT p.r, p.doc_id, p.text, p.pos, p.n_tok, coalesce(g.template, p.line) AS template
  FROM parsed p JOIN wanted w ON w.line = p.line LEFT JOIN general g ON g.line = p.line),
ordered AS (
  SELECT *, first_value(r) OVER w AS first_r, first_value(pos) OVER w AS first_pos
  FROM hits WINDOW w AS (PARTITION BY template ORDER BY doc_id NULLS FIRST, r, pos)),
recurring AS (
  SELECT template FROM hits GROUP BY template, n_tok HAVING count(DISTINCT (doc_id, text)) >= {bar("n_tok")}),
drops AS (
  SELECT r, pos FROM ordered JOIN recurring USING (template) WHERE NOT (r = first_r AND pos = first_pos))
SELECT raw.doc_id AS doc_id,
  CASE WHEN any_value(raw.text) IS NULL THEN NULL
       ELSE coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (d.r IS NULL AND l.r IS NOT NULL), '') END AS text,
  CAST(count(l.r) AS BIGINT) AS n_lines, CAST(count(d.r) AS BIGINT) AS n_dropped
FROM raw LEFT JOIN lines l ON l.r = raw.r LEFT JOIN drops d ON d.r = l.r AND d.pos = l.pos
GROUP BY raw.r, raw.doc_id
"""
