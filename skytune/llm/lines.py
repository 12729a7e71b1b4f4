"""Repeated lines: which lines of which documents go, as run-length coded keep bitmaps.

Keys are hashed to 128 bits and written once, without texts. They are dealt by range and sorted by
document and position inside, so the first holder of a key comes first, its number of documents
follows from ranks in the same order, and no key is joined with its lines again. Keys of more lines
than a task should hold are told beforehand by their counts; they are few, so they are sent to the
lines instead. Texts are read again only to apply the bitmaps. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytune.session import written

#: Lines of one key that are never too many for a task.
FEW = 1000

WHITE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def row_mark(text: Column) -> Column:
    """Tells rows of one document id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed_lines(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, doc, mark, pos) of every line whose key is long enough, in documents with an id."""
    text = F.col(f"`{text_col}`")
    lines = docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        row_mark(text).alias("mark"),
        F.posexplode(lines_of(text)).alias("pos", "line"),
    ).where(F.col("doc").isNotNull() & (F.char_length("line") >= min_chars))
    key = line_key(F.col("line"))
    return lines.select("doc", "mark", "pos", key.alias("key")).where(
        F.char_length("key") >= min_chars
    ).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "mark", "pos"
    )


def runs_of(places: Column) -> Column:
    """Sorted distinct places as runs (start, length)."""
    first = F.filter(
        places, lambda p, i: (i == 0) | (F.get(places, i - 1) != p - 1)
    )
    last = F.filter(
        places, lambda p, i: (i == F.size(places) - 1) | (F.get(places, i + 1) != p + 1)
    )
    return F.transform(
        first, lambda p, i: F.struct(p.alias("start"), (F.get(last, i) - p + 1).alias("length"))
    )


def line_drops(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    partitions: int | None = None,
    share: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document row that loses lines: (doc, mark, drops), the bitmap as runs of lost lines.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    their lines except in the largest id that holds them. Rows with equal ids count as one
    document. Rows without an id neither count nor lose lines. An empty table gives no row.

    Keys of more than ``share`` lines, a quarter of a task's part by default, stay where they are.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = written(keyed_lines(docs, min_chars, id_col, text_col), "lines")
    most = share or max(keyed.count() // (4 * n), FEW)
    key = ["h1", "h2"]
    many = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("lines")).where(F.col("lines") > most)
    hot = F.broadcast(written(many.select(*key), "hot_lines"))  # at most 4 * n keys, by ``most``
    last = F.col("doc").desc()
    dealt = (
        keyed.join(hot, key, "left_anti")
        .repartitionByRange(n, *key)
        .sortWithinPartitions(*key, last, "pos")
    )
    same = Window.partitionBy(*key)
    ranked = dealt.withColumn("holder", F.dense_rank().over(same.orderBy(last)))
    counted = ranked.withColumn("docs", F.max("holder").over(same))
    lost = counted.where((F.col("docs") >= min_docs) & (F.col("holder") > 1))
    own = keyed.join(hot, key)
    common = (
        own.select(*key, "doc").distinct().groupBy(*key)
        .agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
    )
    beside = own.join(F.broadcast(common), key).where(F.col("doc") != F.col("keeper"))
    lost = lost.select("doc", "mark", "pos").union(beside.select("doc", "mark", "pos"))
    return lost.groupBy("doc", "mark").agg(
        runs_of(F.sort_array(F.collect_set("pos"))).alias("drops")
    )


def keep_runs(drops: Column, n_lines: Column) -> Column:
    """The runs of kept lines between the lost ones."""
    starts = F.concat(
        F.array(F.lit(0)), F.transform(drops, lambda r: r["start"] + r["length"])
    )
    ends = F.concat(F.transform(drops, lambda r: r["start"]), F.array(n_lines))
    both = F.transform(
        starts, lambda s, i: F.struct(s.alias("start"), (F.get(ends, i) - s).alias("length"))
    )
    return F.filter(both, lambda r: r["length"] > 0)


def kept_text(text: Column, drops: Column) -> Column:
    """The text without its lost lines; the text itself where none is lost."""
    lines = lines_of(text)
    kept = F.transform(
        keep_runs(drops, F.size(lines)), lambda r: F.slice(lines, r["start"] + 1, r["length"])
    )
    return F.when(drops.isNull(), text).otherwise(F.array_join(F.flatten(kept), "\n"))


def with_line_drops(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int
) -> DataFrame:
    """(row, id, text, drops): all columns of ``docs`` as one, and its lost lines, null if none."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), text.alias("text"),
        row_mark(text).alias("mark"),
    )
    drops = line_drops(docs, id_col=id_col, text_col=text_col, **options)
    met = (rows["id"] == drops["doc"]) & (rows["mark"] == drops["mark"])
    return rows.join(drops, met, "left").select("row", "id", "text", "drops")


def line_report(docs: DataFrame, **options: int) -> DataFrame:
    """Per document row: lines, lost lines and the digest of what stays."""
    text = F.coalesce("text", F.lit(""))
    lost = F.aggregate("drops", F.lit(0), lambda total, r: total + r["length"])
    return with_line_drops(docs.select("doc_id", "text"), **options).select(
        F.col("id").alias("doc_id"),
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(text, F.col("drops")), 256).alias("kept_sha256"),
    )


def drop_lines(docs: DataFrame, **options: int) -> DataFrame:
    """``docs`` with the same columns, texts without their lost lines."""
    kept = kept_text(F.col("text"), F.col("drops"))
    return with_line_drops(docs, **options).select(
        *(kept.alias("text") if c == "text" else F.col("row").getField(c).alias(c)
          for c in docs.columns)
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(
    trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT d.doc_id, d.pos, d.line, c.k IS NOT NULL AND c.keeper <> d.doc_id AS gone
  FROM keyed d LEFT JOIN common c ON d.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
