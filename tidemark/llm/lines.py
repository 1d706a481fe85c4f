"""Line dedup by overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_texts, shielded, table
from tidemark.session import materialize

WINDOW = 3
#: Second hash of a window, under another prefix: 128 bits name a window.
SALT = "second"


def _windows(lines: Column, width: int) -> Column:
    """Array of (position, two hashes) of each window with a line that isn't blank."""
    starts = F.sequence(F.lit(0), F.size(lines) - width)

    def at(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(width)]
        filled = F.trim(F.concat(*part)) != ""
        return F.when(
            filled,
            F.struct(i.alias("pos"), F.xxhash64(*part).alias("h1"), F.xxhash64(F.lit(SALT), *part).alias("h2")),
        )

    return F.when(F.size(lines) >= width, F.array_compact(F.transform(starts, at)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` rid of repeated windows, and ``n_lines`` and ``n_removed`` (long) added.

    A window is ``width`` consecutive lines, cut at ``\\n``; windows of blank lines alone don't count. Of equal
    windows anywhere in the table the first stays, by document (ascending id, nulls last) and position; every line
    covered by a later one goes. Windows are judged on the input. A null text stays null with no lines; a text of
    fewer lines than a window is left alone; rows equal in id and text are one document. Existing columns named
    ``n_lines`` or ``n_removed`` are replaced, all others kept whatever their names.

    The shuffles carry hashes and positions; a text is shuffled once, to meet the positions to remove.
    """
    keyed = keyed_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    # a column of its own, read more than once: Spark then cuts a text once and not once for each line
    cut = keyed.select("_id", "_th", F.split("text", "\n").alias("_lines"))
    found = cut.select("_id", "_th", F.explode(_windows(F.col("_lines"), width)).alias("w"))
    found = found.select("_id", "_th", "w.pos", "w.h1", "w.h2")
    firsts = found.groupBy("h1", "h2").agg(F.min(F.struct("_id", "_th", "pos")).alias("first"), F.count("*").alias("n"))
    # written, so that a hot window's rows can be split when they are joined
    firsts = materialize(firsts.where("n > 1").drop("n"), "line-windows")
    later = found.join(firsts, ["h1", "h2"]).where(F.struct("_id", "_th", "pos") > F.col("first"))
    covered = later.select("_id", "_th", F.explode(F.sequence("pos", F.col("pos") + (width - 1))).alias("pos"))
    covered = covered.groupBy("_id", "_th").agg(F.collect_set("pos").alias("_gone"))
    covered = materialize(covered, "line-positions").select(
        F.col("_id").alias("_cid"), F.col("_th").alias("_cth"), "_gone"
    ).hint("shuffle_hash")  # texts stream past the few positions and aren't sorted
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")])
    rows, named = shielded(kept, (id_col, text_col))
    marked = keyed_texts(rows, id_col, text_col)
    joined = marked.join(covered, (F.col("_id") == F.col("_cid")) & (F.col("_th") == F.col("_cth")), "left")
    joined = joined.withColumn("_lines", F.split(text_col, "\n"))
    lines = F.col("_lines")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    left = F.array_join(F.transform(F.array_sort(stay), lambda i: F.get(lines, i)), "\n")
    return joined.withColumns(
        {
            "n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
            text_col: F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(left),
        }
    ).select(*named, "n_lines", "n_removed")


def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, pos, l[pos + 1] AS a, l[pos + 2] AS b, l[pos + 3] AS c
  FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM lines WHERE len(l) >= 3)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS k
    FROM w WHERE trim(concat(a, b, c)) <> '')
  WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + d AS pos FROM later, (VALUES (0), (1), (2)) AS s(d)
), each AS (
  SELECT doc_id, l, unnest(range(0, len(l))) AS pos FROM lines
), kept AS (
  SELECT e.doc_id, count(g.pos) AS n_removed, count(*) AS n_lines,
         coalesce(string_agg(e.l[e.pos + 1], chr(10) ORDER BY e.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
