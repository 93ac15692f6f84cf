"""Removal of line passages that repeat anywhere in the corpus, with DataFrame functions only.

A rolling hash runs over the hashes of each document's lines, ``WINDOW`` lines at a time. A boundary
lies between two lines whose rolling hash stands at no earlier place of the corpus (smaller id, or
further up in the document); what lies between two boundaries is a chunk. So boundaries depend on the
lines beside them alone, they move with inserted lines, and a chunk is a repeated passage in its whole
length, wherever it begins and ends. Chunks of at least ``MIN_LINES`` lines that aren't empty go, once
the bytes under equal hashes have been compared. The first place of every line stays.

* Scan: a hash and a position per window; texts stay where they are.
* Hashes that occur once leave the job after a map-side combined count with the first place.
* A hash in more than 1 of ``CROWDED`` of the repeated windows is looked up map-side: there are fewer
  than ``CROWDED`` of those in any corpus. The others are small enough to meet in a task.
* Only repeated windows give their lines to the byte comparison, a grouping by the text itself, which
  combines copies before they move. A hash under which two texts were found removes nothing.
* Texts meet their places and cuts in a sorted merge in corpora of any size: no executor is sent a table
  that grows with the corpus, and what moves and lies on disk is in proportion to the text.

Defined results: a null or empty text and a row with a null id come back unchanged; rows that repeat
an id count as one document; a document of which nothing is left has the empty text; other columns
pass through untouched, whatever their names (an existing ``lines_removed`` is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_table, fresh_name, quoted, replace_column
from tidemark.sources.scratch import scratch_path, scratch_scope, stored, stored_at

WINDOW = 2
MIN_LINES = 2
CROWDED = 4096
_MODULI = (2147483647, 2147483629)
_BASE = 1000003


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _rolled(before: Column, line: Column) -> Column:
    """The rolling hash of two line hashes: 31 bits under each modulus."""
    parts = [(F.pmod(before, F.lit(m)) * _BASE + F.pmod(line, F.lit(m))) % m for m in _MODULI]
    return F.shiftleft(parts[0].cast("bigint"), 31) + parts[1]


def line_windows(text: Column) -> Column:
    """Each two adjacent lines: number of the second (from 1), rolling hash, whether each is not empty."""

    def windows(hashes: Column, lines: Column) -> Column:
        def window(i: Column) -> Column:
            key = _rolled(F.element_at(hashes, i - 1), F.element_at(hashes, i))
            filled = [(F.element_at(lines, j) != "").cast("int") for j in (i - 1, i)]
            return F.struct(i.alias("i"), key.alias("key"), filled[0].alias("filled_before"), filled[1].alias("filled"))

        return F.transform(F.sequence(F.lit(WINDOW), F.size(lines)), window)

    return _let(_lines(text), lambda lines: _let(F.transform(lines, lambda line: F.xxhash64(line)), lambda h: windows(h, lines)))


def _row(ident: Column, text: Column) -> Column:
    """Tells rows of one id apart; null where the id is."""
    return F.when(ident.isNotNull(), F.xxhash64(ident.cast("string"), text))


def repeated_windows(rows: DataFrame) -> DataFrame:
    """All places (id, row, i, key, ...) of windows that occur more than once; ``later``: not the first."""
    places = rows.select("id", "row", F.inline(line_windows(F.col("text"))))
    counted = places.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "i")).alias("first"))
    counted = stored(counted.filter("n > 1"), "line-windows")
    limit = (counted.agg(F.sum("n")).first()[0] or 0) // CROWDED
    crowded = F.broadcast(counted.filter(F.col("n") > limit + 1))
    rest = places.join(F.broadcast(crowded.select("key")), "key", "left_anti")
    found = places.join(crowded, "key").unionByName(rest.join(counted.filter(F.col("n") <= limit + 1), "key"))
    later = (F.struct("id", "i") != F.col("first")).alias("later")
    return found.select("id", "row", "i", "key", "filled_before", "filled", later)


def _unequal(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Hashes under which different bytes stand."""
    asked = windows.groupBy(F.col("id").alias("asked"), F.col("row").alias("asked_row")).agg(
        F.collect_set(F.struct("i", "key")).alias("wanted")
    )
    joined = rows.join(asked.hint("merge"), (F.col("id") == F.col("asked")) & (F.col("row") == F.col("asked_row")))

    def shown(lines: Column) -> Column:
        def both(w: Column) -> Column:
            text = F.concat_ws("\n", F.element_at(lines, w["i"] - 1), F.element_at(lines, w["i"]))
            return F.struct(w["key"].alias("key"), text.alias("bytes"))

        return F.transform("wanted", both)

    texts = joined.select(F.inline(_let(_lines(F.col("text")), shown))).distinct()
    return texts.groupBy("key").agg(F.count("*").alias("texts")).filter("texts > 1").select("key")


def repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES
) -> DataFrame:
    """(id, row, chunks): the chunks to remove as (first line, last line) in order, lines from 1."""
    rows = as_table(docs, id=id_col, text=text_col).filter("id is not null and instr(text, '\n') > 0")
    rows = rows.withColumn("row", _row(F.col("id"), F.col("text")))
    windows = stored(repeated_windows(rows), "line-places")
    later, unequal = windows.filter("later"), stored(_unequal(rows, windows), "unequal-lines")
    if not unequal.isEmpty():
        later = later.join(unequal, "key", "left_anti")
    later = later.repartition("id", "row").dropDuplicates(["id", "row", "i"])
    number = F.row_number().over(Window.partitionBy("id", "row").orderBy("i"))
    chunks = later.withColumn("chunk", F.col("i") - number).groupBy("id", "row", "chunk").agg(
        F.min(F.struct("i", "filled_before")).alias("start"), F.max("i").alias("stop"), F.sum("filled").alias("filled")
    )
    return (
        chunks.filter(F.col("filled") + F.col("start.filled_before") >= min_lines)
        .groupBy("id", "row")
        .agg(F.sort_array(F.collect_list(F.struct((F.col("start.i") - 1).alias("start"), "stop"))).alias("chunks"))
    )


def _lines_left(lines: Column, chunks: Column) -> Column:
    """The lines before, between and after the chunks."""
    end = F.size(lines) + 1
    stops = F.concat(chunks, F.array(F.struct(end.alias("start"), end.alias("stop"))))

    def between(all_stops: Column) -> Column:
        def part(chunk: Column, k: Column) -> Column:
            before = F.when(k == 0, F.lit(0)).otherwise(F.element_at(all_stops, F.greatest(k, F.lit(1)))["stop"])
            return F.slice(lines, before + 1, chunk["start"] - before - 1)

        return F.flatten(F.transform(all_stops, part))

    return _let(stops, between)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    removed_col: str = "lines_removed",
) -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and the number of lines that went."""
    row, cut, kept = fresh_name(docs, "own_row"), fresh_name(docs, "gone"), fresh_name(docs, "kept")
    ident, text, cuts = F.col(quoted(id_col)), F.col(quoted(text_col)), F.col(quoted(cut))
    path = scratch_path(docs.sparkSession, "line-chunks")
    with scratch_scope(docs.sparkSession):  # of what it takes to find the chunks nothing stays
        chunks = stored_at(repeated_chunks(docs, id_col, text_col, min_lines), path)
    gone = chunks.select(
        F.col("id").alias(fresh_name(docs, "removed_from")), F.col("row").alias(fresh_name(docs, "removed_row")),
        F.col("chunks").alias(cut),
    )
    of_id, of_row, _ = gone.columns
    keyed = docs.withColumn(row, _row(ident, text))
    joined = keyed.join(gone.hint("merge"), (keyed[quoted(id_col)] == gone[of_id]) & (keyed[row] == gone[of_row]), "left")
    left = _let(_lines(text), lambda lines: F.array_join(_lines_left(lines, cuts), "\n"))
    joined = joined.withColumns({
        removed_col: F.when(cuts.isNull(), 0).otherwise(
            F.aggregate(cuts, F.lit(0), lambda n, c: n + c["stop"] - c["start"] + 1)
        ),
        kept: F.when(cuts.isNull(), text).otherwise(left),
    })
    return replace_column(joined.drop(row, of_id, of_row, cut), text_col, kept)


ORACLE_SQL = f"""WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents),
pair AS (SELECT doc_id, i, line, lag(line) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM line),
marked AS (SELECT *, row_number() OVER (PARTITION BY before, line ORDER BY doc_id, i) > 1 AS later FROM pair WHERE i > 1),
placed AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM marked WHERE later),
gone AS (SELECT doc_id, min(i) - 1 AS start, max(i) AS stop FROM placed GROUP BY doc_id, chunk
  HAVING count(*) FILTER (line <> '') + CASE WHEN arg_min(before, i) <> '' THEN 1 ELSE 0 END >= {MIN_LINES}),
left_over AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text FROM line l
  ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.i >= g.start AND l.i <= g.stop GROUP BY l.doc_id),
removed AS (SELECT doc_id, sum(stop - start + 1) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(r.n, 0) AS BIGINT) AS lines_removed,
  md5(CASE WHEN r.n IS NULL THEN d.text ELSE coalesce(k.text, '') END) AS kept_md5
FROM documents d LEFT JOIN removed r USING (doc_id) LEFT JOIN left_over k USING (doc_id)"""
