"""Line dedup over overlapping three-line windows, in DataFrame functions only.

Windows are runs of three consecutive non-blank lines of one text. A window seen more than once anywhere keeps its
first occurrence, by (doc_id, position); every later one marks its three lines, and marked lines go. Overlapping
marks merge, so a long repeated passage goes as a whole. Each removed line still stands somewhere earlier.

Defined cases: blank lines neither form windows nor go; a text of fewer than three non-blank lines is left alone;
null text stays null with 0 lines; null ids sort first; rows repeated in full (id and text) count as one document and
get the same result; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import KEY, names_kept, with_key, written

LINES = 3


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _filled(lines: str) -> Column:
    """Indices of the non-blank lines."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(F.col(lines), i) != "")


def windows(docs: DataFrame) -> DataFrame:
    """One row per window: the document's key, the window's position among non-blank lines, and a 128-bit hash."""
    texts = with_key(docs).select(*KEY, F.filter(_lines(), lambda x: x != "").alias("lines"))
    last = F.size("lines") - LINES
    line = F.col("lines")
    hashes = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.unhex(F.md5(F.concat_ws("\n", *[F.get(line, i + n) for n in range(LINES)]).cast("binary"))),
    )
    return texts.select(*KEY, F.posexplode(hashes).alias("at", "hash"))


def later_windows(docs: DataFrame) -> DataFrame:
    """Keys and positions of windows that occur earlier too.

    The first occurrence is a plain aggregate, combined before the shuffle, so a window in a third of all rows is
    cheap; the join back is on the hash alone, where a hot hash may be split because the other side has it once.
    """
    found = written(windows(docs), "line-windows")
    first = (
        found.groupBy("hash")
        .agg(F.min(F.struct(*KEY, "at")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("hash", "first")
    )
    return found.join(first, "hash").where(F.struct(*KEY, "at") != F.col("first")).select(*KEY, "at")


@names_kept
def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cleaned, and ``__n_lines``, ``__n_removed`` (longs)."""
    marks = later_windows(docs).groupBy(*KEY).agg(F.collect_set("at").alias("__marks"))
    rows = with_key(docs).join(marks, KEY, "left").withColumn("__lines", _lines())
    filled = _filled("__lines")
    gone = F.array_distinct(F.flatten(F.transform("__marks", lambda at: F.slice("__filled", at + 1, LINES))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    marked = F.col("__marks").isNotNull()
    return (
        rows.withColumn("__filled", F.when(marked, filled))
        .withColumn("__gone", F.when(marked, gone))
        .withColumns(
            {
                "text": F.when(marked, F.array_join(F.transform(kept, lambda i: F.get(F.col("__lines"), i)), "\n")).otherwise(F.col("text")),
                "__n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines")).cast("long"),
                "__n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
            }
        )
        .select(*[F.col(f"`{c}`") for c in docs.columns], "__n_lines", "__n_removed")
    )


#: The same rule on DuckDB; ``{docs}`` has doc_id and text.
ORACLE = """
WITH lines AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS parts FROM {docs}
), one AS (
  SELECT doc_id, i - 1 AS line_no, parts[i] AS line
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM lines)
), filled AS (
  SELECT *, row_number() OVER w - 1 AS place,
         lead(line, 1) OVER w AS next1, lead(line, 2) OVER w AS next2
  FROM one WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)
), wins AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY line, next1, next2 ORDER BY doc_id, place) AS nth
  FROM filled WHERE next2 IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, place + k AS place FROM wins, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
), kept AS (
  SELECT one.doc_id, string_agg(one.line, chr(10) ORDER BY one.line_no) AS text, count(*) AS n_kept
  FROM one LEFT JOIN filled USING (doc_id, line_no)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = one.doc_id AND gone.place = filled.place)
  GROUP BY one.doc_id
)
SELECT lines.doc_id, CASE WHEN lines.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(len(parts) AS BIGINT) AS n_lines, CAST(len(parts) - coalesce(n_kept, 0) AS BIGINT) AS n_removed
FROM lines LEFT JOIN kept USING (doc_id)
"""
