"""Line dedup over content-defined chunks of lines, in DataFrame functions only.

A text is cut into lines at line feeds.  A rolling hash over the hashes of a line and
the one before decides, from these two lines alone, whether a chunk ends there; so an
inserted or deleted line moves the boundaries next to it and no others.  A chunk of at
least ``min_lines`` lines that occurs more than once in the corpus keeps its first
occurrence (smallest id, then position) and is cut out of the others.  Signatures find
the candidates; the bytes of the candidates decide.

The chunks are what the SQL twin of ``op6_lines`` fixes.  They find a passage only where
boundaries happen to lie inside it.  ``cut_passages`` misses none: it looks at the
shortest run of whole lines with over ``over_words`` words from each line on, and at the
shortest one that ends at each line.  A repeated passage of over ``over_words`` words is
the union of such runs that lie in it, and each run is looked up by its own content.
Hashes find the candidates; SHA-256 of their bytes decides.

Defined cases: a null text has no lines and stays null; an empty text has one, empty,
line; rows of equal id and text are one document; a null id comes before all others;
a text all of whose lines go becomes empty and keeps its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm.common import carried, query, table
from clickroll.session import stored

CHUNK_LINES = 4
"""Lines of a chunk, in the mean."""

# Fixed values of the rolling hash; the SQL twin uses them too.
ROLL, MODULUS = 131, 1_000_003


def lines_of(text: Column) -> Column:
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def chunk_spans(lines: Column, chunk_lines: int = CHUNK_LINES) -> Column:
    """(no, start, size) of each chunk; chunks are numbered from 0, lines from 1."""
    hashes = F.transform(lines, line_hash)
    n = F.size(lines)

    def ends_at(at: Column, hashed: Column) -> Column:
        roll = F.element_at(hashed, at) * ROLL + F.element_at(hashed, at - 1)
        return (roll % MODULUS) % chunk_lines == 0

    def spans(hashed: Column) -> Column:
        inner = F.when(n > 2, F.filter(F.sequence(F.lit(2), n - 1), lambda i: ends_at(i, hashed)))
        ends = F.concat(F.coalesce(inner, F.array().cast("array<int>")), F.array(n))
        return F.transform(ends, lambda end, k: F.struct(
            k.alias("no"),
            F.when(k == 0, 1).otherwise(F.element_at(ends, k) + 1).alias("start"),
            F.when(k == 0, end).otherwise(end - F.element_at(ends, k)).alias("size")))

    # the hashes are bound once, not computed anew for each position
    bound = F.transform(F.array(hashes), spans)
    return F.when(n > 0, F.element_at(bound, 1))


def _body(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["start"], span["size"]), "\n")


def removed_chunks(documents: DataFrame, *, key: str = "doc_id", text: str = "text",
                   chunk_lines: int = CHUNK_LINES, min_lines: int = 2) -> DataFrame:
    """``(_id, _h, gone)``: the numbers of the chunks to cut, for rows that have some.

    ``_h`` is the hash of the text, so that rows that share an id are told apart.
    """
    rows = documents.select(F.col(key).alias("_id"), F.col(text).alias("_t"), F.xxhash64(text).alias("_h"))
    cut = rows.select("_id", "_h", lines_of(F.col("_t")).alias("_l")).withColumn(
        "_s", F.explode(F.filter(chunk_spans(F.col("_l"), chunk_lines), lambda s: s["size"] >= min_lines)))
    signed = stored(cut.select(
        "_id", "_h", F.col("_s.no").alias("no"), F.md5(_body(F.col("_l"), F.col("_s")).cast("binary")).alias("sig"),
    ), "chunks")
    repeated = signed.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    wanted = signed.join(repeated, "sig", "left_semi").groupBy(
        F.col("_id").alias("_i"), F.col("_h").alias("_g")).agg(F.collect_set(F.struct("no", "sig")).alias("w"))
    # of the texts that hold a repeated signature, the chunks that carry it
    found = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")))
    spans = found.select("_id", "_h", "w", lines_of(F.col("_t")).alias("_l")).withColumn(
        "_s", chunk_spans(F.col("_l"), chunk_lines))
    bodies = spans.select("_id", "_h", "_l", "_s", F.explode("w").alias("_w")).select(
        "_id", "_h", F.col("_w.no").alias("no"), F.col("_w.sig").alias("sig"),
        _body(F.col("_l"), F.element_at(F.col("_s"), F.col("_w.no") + 1)).alias("body"))
    bodies = stored(bodies, "bodies")
    place = F.struct("_id", "no")
    first = bodies.groupBy("sig", "body").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where("first <> last")
    cut_out = bodies.join(first, ["sig", "body"]).where(place != F.col("first"))
    return cut_out.groupBy("_id", "_h").agg(F.collect_set("no").alias("gone"))


def dedup_lines(documents: DataFrame, *, key: str = "doc_id", text: str = "text",
                chunk_lines: int = CHUNK_LINES, min_lines: int = 2) -> DataFrame:
    """The rows of ``documents`` with repeated chunks cut out of ``text``.

    ``_n_lines`` and ``_n_removed`` count the lines before and those cut.
    """
    gone = removed_chunks(documents, key=key, text=text, chunk_lines=chunk_lines, min_lines=min_lines).select(
        F.col("_id").alias("_i"), F.col("_h").alias("_g"), "gone")
    own = carried(documents, _key=F.col(key), _t=F.col(text), _h=F.xxhash64(text))
    both = own.join(gone, F.col("_key").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")), "left")
    lines = lines_of(F.col("_t"))
    kept = F.filter(chunk_spans(lines, chunk_lines), lambda s: ~F.array_contains("gone", s["no"]))
    kept_lines = F.flatten(F.transform(kept, lambda s: F.slice(lines, s["start"], s["size"])))
    both = both.withColumn("_n_lines", F.size(lines)).withColumn(
        "_kept", F.when(F.col("gone").isNotNull(), kept_lines))
    new_text = F.when(F.col("gone").isNull(), F.col("_t")).otherwise(F.array_join("_kept", "\n"))
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.col("_n_lines") - F.size("_kept"))
    return both.select(
        *[new_text.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in documents.columns],
        F.col("_n_lines"), removed.alias("_n_removed"))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def worded_lines(lines: Column) -> Column:
    """(no, words) of the lines that hold a word; lines are numbered from 1."""
    counted = F.transform(lines, lambda line, i: F.struct(
        (i + 1).alias("no"), F.regexp_count(line, F.lit(r"\S+")).alias("words")))
    return F.filter(counted, lambda c: c["words"] > 0)


def passage_spans(worded: Column, over_words: int) -> Column:
    """(a, b) of the shortest runs of over ``over_words`` words that begin or end at a line.

    ``a`` and ``b`` count the lines with words, from 1.
    """
    def spans(at: Column) -> Column:
        starts = F.when(F.size(at) > over_words, F.sequence(F.lit(1), F.size(at) - over_words))

        def edge(p: Column) -> Column:
            last = p + over_words
            return (p == 1) | (last == F.size(at)) | (F.get(at, p - 2) < F.get(at, p - 1)) | (
                F.get(at, last) > F.get(at, last - 1))

        runs = F.transform(F.filter(starts, edge), lambda p: F.struct(
            F.element_at(at, p).alias("a"), F.element_at(at, p + over_words).alias("b")))
        return F.array_distinct(runs)

    # the line of each word
    return _bound(F.flatten(F.transform(worded, lambda c, k: F.array_repeat(k + 1, c["words"]))), spans)


def _run(of: Column, worded: Column, span: Column) -> Column:
    first = F.element_at(worded, span["a"])["no"]
    return F.slice(of, first, F.element_at(worded, span["b"])["no"] - first + 1)


def removed_passages(documents: DataFrame, *, key: str = "doc_id", text: str = "text",
                     over_words: int = 50) -> DataFrame:
    """``(_id, _h, gone)``: the lines with words to cut, counted among these, for rows that have some.

    A run stays at its first place (smallest id, then hash of the text, then line), and
    where it overlaps that place.
    """
    rows = documents.select(F.col(key).alias("_id"), F.col(text).alias("_t"), F.xxhash64(text).alias("_h"))

    def signed_spans(lines: Column) -> Column:
        return _bound(F.transform(lines, lambda line: F.xxhash64(line)), lambda hashes: _bound(
            worded_lines(lines), lambda worded: F.transform(passage_spans(worded, over_words), lambda s: F.struct(
                s["a"].alias("a"), s["b"].alias("b"), F.xxhash64(_run(hashes, worded, s)).alias("sig")))))

    signed = stored(rows.select("_id", "_h", F.explode(_bound(lines_of(F.col("_t")), signed_spans)).alias("_s"))
                    .select("_id", "_h", "_s.*"), "runs")
    place = F.struct("_id", "_h", "a", "b")
    repeated = signed.groupBy("sig").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    wanted = signed.join(repeated, "sig", "left_semi").groupBy(
        F.col("_id").alias("_i"), F.col("_h").alias("_g")).agg(F.collect_set(F.struct("a", "b")).alias("w"))
    found = rows.dropDuplicates(["_id", "_h"]).join(
        wanted, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")))

    def digests(lines: Column) -> Column:
        return _bound(worded_lines(lines), lambda worded: F.transform("w", lambda s: F.struct(
            s["a"].alias("a"), s["b"].alias("b"),
            F.unhex(F.sha2(F.array_join(_run(lines, worded, s), "\n").cast("binary"), 256)).alias("sha"))))

    bodies = stored(found.select("_id", "_h", F.explode(_bound(lines_of(F.col("_t")), digests)).alias("_s"))
                    .select("_id", "_h", "_s.*"), "run-bodies")
    first = bodies.groupBy("sha").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    same = F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("_h") == F.col("first._h"))
    cut_out = bodies.join(first, "sha").where(~same | (F.col("a") > F.col("first.b")))
    runs = cut_out.groupBy("_id", "_h").agg(F.collect_set(F.struct("a", "b")).alias("r"))
    numbers = F.flatten(F.transform("r", lambda s: F.sequence(s["a"], s["b"])))
    return runs.select("_id", "_h", F.sort_array(F.array_distinct(numbers)).alias("gone"))


def cut_passages(documents: DataFrame, *, key: str = "doc_id", text: str = "text", over_words: int = 50) -> DataFrame:
    """The rows of ``documents`` without the whole lines that stand, as a passage of over
    ``over_words`` words, at an earlier place; lines without words between two of them go too."""
    gone = removed_passages(documents, key=key, text=text, over_words=over_words).select(
        F.col("_id").alias("_i"), F.col("_h").alias("_g"), "gone")
    own = carried(documents, _key=F.col(key), _t=F.col(text), _h=F.xxhash64(text))
    both = own.join(gone, F.col("_key").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")), "left")

    def rest(lines: Column, worded: Column) -> Column:
        def no(k: Column) -> Column:
            return F.element_at(worded, k)["no"]

        cut = F.flatten(F.transform("gone", lambda k, m: F.when(
            (m > 0) & (F.get(F.col("gone"), m - 1) == k - 1), F.sequence(no(F.greatest(k - 1, F.lit(1))) + 1, no(k)),
        ).otherwise(F.array(no(k)))))
        kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), cut), lambda i: F.element_at(lines, i))
        return F.when(F.size("gone") == F.size(worded), F.lit("")).otherwise(F.array_join(kept, "\n"))

    left = _bound(lines_of(F.col("_t")), lambda lines: _bound(worded_lines(lines), lambda worded: rest(lines, worded)))
    new_text = F.when(F.col("gone").isNull(), F.col("_t")).otherwise(left)
    return both.select(*[new_text.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in documents.columns])


_SQL = f"""
WITH lines AS (
  SELECT doc_id, no, line, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS no
    FROM documents)),
cuts AS (
  SELECT *, coalesce(no >= 2 AND ((h * {ROLL} + lag(h) OVER w) % {MODULUS}) % {CHUNK_LINES} = 0, false) AS cut
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
placed AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY no
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM cuts),
chunks AS (
  SELECT doc_id, chunk, count(*) AS size, string_agg(line, chr(10) ORDER BY no) AS body FROM placed GROUP BY ALL),
gone AS (
  SELECT doc_id, chunk FROM (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) AS k FROM chunks WHERE size >= 2)
  WHERE k > 1),
kept AS (
  SELECT c.doc_id, count(*) AS n_lines, count(g.chunk) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE g.chunk IS NULL), '') AS text
  FROM placed c LEFT JOIN gone g USING (doc_id, chunk) GROUP BY c.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""


@query("op6_lines", _SQL)
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
