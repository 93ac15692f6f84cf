"""Removal of every byte covered by a long string that stands anywhere else in the corpus.

A string of ``LENGTH`` bytes that repeats is found in buffers of bounded size by two-stage suffix
sorting and adjacent common prefixes. What must meet in one buffer is brought together by content:

* Every string holds one anchor, its smallest run of ``ANCHOR`` bytes by a hash, so equal strings
  have equal anchors. Consecutive strings of a document with the same anchor are one segment. A scan
  gives a row per segment (anchor, checksum of the segment, place), about one for 75 bytes of text.
* Rows are dealt by anchor; anchors that occur once end there. Of segments with the same bytes one
  goes on, marked as having a twin: what is found for it holds for all. So copies are one segment.
* These segments' bytes are fetched and sorted, several anchors to a buffer.
* An anchor with more than ``MOST_SEGMENTS`` different segments (the edges of a passage that a large
  part of the corpus contains) is not gathered: its strings are dealt by their own checksums.

Strings are judged on the input; overlaps count; matches never cross rows. Places are found again by
a checksum of a row's id and text.

Defined results: a null text is empty and stays null where texts are returned; rows that repeat an id
and a text are each other's copies; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table, fresh_name, quoted, replace_column
from tidemark.llm.graph import sorted_groups
from tidemark.llm.shingles import _powers, mixed
from tidemark.llm.suffix_sort import repeated_starts
from tidemark.sources.scratch import cut_lineage, stored

LENGTH = 200
ANCHOR = 48
MOST_SEGMENTS = 8192
_BUFFER = 500_000
_PART = 1 << 20  # bytes of text looked at together
_PLACE_BITS = np.uint64(26)
_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima inside blocks of that width."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, bounds: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(anchor, checksum, text, first string, strings) of each segment of texts cut at ``bounds``."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    up, down = _powers(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[:-1])])

    def checksum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))

    n = len(data) - anchor + 1
    grams = mixed((sums[anchor:] - sums[:n]) * down[:n] + np.uint64(anchor))
    keyed = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)  # of equal ones the first
    place = _sliding_minimum(keyed, length - anchor + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))
    place = place.astype(np.int64)
    strings = np.maximum(np.diff(bounds) - length + 1, 0)
    before = np.cumsum(strings) - strings
    total = int(strings.sum())
    if not total:
        return none
    whole = np.arange(total) + np.repeat(bounds[:-1] - before, strings)
    held = place[whole]
    new = np.ones(total, bool)
    new[1:] = held[1:] != held[:-1]
    new[before[strings > 0]] = True
    at = np.flatnonzero(new)
    owner = np.searchsorted(before[strings > 0], at, side="right") - 1
    owner = np.flatnonzero(strings > 0)[owner]
    first = whole[at]
    last = whole[np.append(at[1:], total) - 1]
    check = checksum(first, last + length)
    return grams[held[at]].view(np.int64), check.view(np.int64), owner, first - bounds[owner], last - first + 1


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(row ids, offsets, texts): portions of about ``_PART`` bytes, long texts in overlapping pieces."""
    ids, offsets, texts, size = [], [], [], 0
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.binary())):
            text = text.as_py() or b""
            for at in range(0, max(1, len(text) - LENGTH + 1), _PART):
                ids.append(row)
                offsets.append(at)
                texts.append(text[at : at + _PART + LENGTH - 1])
                size += len(texts[-1])
                if size >= _PART:
                    yield ids, offsets, texts
                    ids, offsets, texts, size = [], [], [], 0
    if texts:
        yield ids, offsets, texts


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, offsets, texts in _parts(batches):
        bounds = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        anchor, check, owner, first, count = segments(data, bounds, LENGTH, ANCHOR)
        first = first + np.array(offsets, np.int64)[owner]
        columns = [anchor, check, np.array(ids, np.int64)[owner], first, count]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "segment", "row", "first", "n"])


def _run_positions(same: np.ndarray) -> np.ndarray:
    """Position of each element in its run; ``same``: the element continues the run before it."""
    at = np.arange(len(same))
    return at - np.maximum.accumulate(np.where(same, 0, at))


def _repeated_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (anchor, segment), those of anchors that occur again, with whether the row is the
    ``first`` of its segment, whether that occurs again (``twin``), and its number within the anchor (``kind``)."""
    held: pa.RecordBatch | None = None  # the last row waits for the next
    before, copy0, kind0 = False, 0, 0

    def chosen(batch: pa.RecordBatch, keep: np.ndarray, lead: np.ndarray, twin: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        out = batch.filter(pa.array(keep))
        extra = [pa.array(lead[keep]), pa.array(twin[keep]), pa.array(kind[keep].astype(np.int64))]
        return pa.RecordBatch.from_arrays([*out.columns, *extra], [*out.schema.names, "lead", "twin", "kind"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        anchor, segment = batch.column("anchor").to_numpy(), batch.column("segment").to_numpy()
        same_anchor = np.zeros(len(anchor), bool)
        same_anchor[1:] = anchor[1:] == anchor[:-1]
        same_segment = same_anchor.copy()
        same_segment[1:] &= segment[1:] == segment[:-1]
        copy = _run_positions(same_segment)
        steps = np.cumsum(~same_segment)
        kind = steps - steps[np.arange(len(anchor)) - _run_positions(same_anchor)]
        if held is not None:  # its own runs go on
            copy[_leading(same_segment)] += copy0
            kind[_leading(same_anchor)] += kind0
            same_anchor[0] = before
        keep = same_anchor[:-1] | same_anchor[1:]
        twin = (copy[:-1] > 0) | same_segment[1:]
        n = len(anchor) - 1
        yield chosen(batch.slice(0, n), keep, copy[:-1] == 0, twin, kind[:-1])
        held, before, copy0, kind0 = batch.slice(n), bool(same_anchor[-1]), int(copy[-1]), int(kind[-1])
    if held is not None and before:
        yield chosen(held, np.ones(1, bool), np.array([copy0 == 0]), np.array([copy0 > 0]), np.array([kind0]))


def _leading(same: np.ndarray) -> slice:
    """The first run."""
    breaks = np.flatnonzero(~same[1:])
    return slice(0, int(breaks[0]) + 1 if len(breaks) else len(same))


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        for text, wanted in zip(batch.column("text").cast(pa.binary()), batch.column("wanted").to_pylist()):
            text = text.as_py()
            parts = [text[w["first"] : w["first"] + w["n"] + LENGTH - 1] for w in wanted]
            columns = [*([w[c] for w in wanted] for c in ("anchor", "segment", "twin")), parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                ["anchor", "segment", "twin", "bytes"],
            )


def _found_runs(rows: list[dict]) -> list[tuple[int, int, int, int]]:
    """(anchor, segment, from, to) of the bytes under repeated strings."""
    runs = []
    found = repeated_starts([r["bytes"] for r in rows], LENGTH, [r["twin"] for r in rows])
    for row, starts in zip(rows, found):
        if not len(starts):
            continue
        key = (row["anchor"], row["segment"])
        cuts = np.flatnonzero(np.diff(starts) > LENGTH)
        for a, b in zip(starts[np.append(0, cuts + 1)].tolist(), starts[np.append(cuts, len(starts) - 1)].tolist()):
            runs.append((*key, a, b + LENGTH))
    return runs


def _sorted_buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix sorting of rows that come by anchor; anchors share a buffer, none is split."""
    rows, size = [], 0

    def result(runs: list) -> pa.RecordBatch:
        columns = [*zip(*runs)] if runs else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "segment", "begin", "stop"])

    for _, group in sorted_groups(batches, "anchor"):
        rows += group
        size += sum(len(r["bytes"]) for r in group)
        if size > _BUFFER:
            yield result(_found_runs(rows))
            rows, size = [], 0
    yield result(_found_runs(rows) if rows else [])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two checksums of every string of the segments."""
    for batch in batches:
        for row in batch.to_pylist():
            data = np.frombuffer(row["bytes"], np.uint8)
            at = np.arange(len(data) - LENGTH + 1)
            up, down = _powers(len(data))
            sums = []
            for salt in (np.uint64(0), np.uint64(0x632BE59BD9B4E019)):
                total = np.concatenate([[np.uint64(0)], np.cumsum((_BYTE[data] ^ salt) * up[:-1])])
                sums.append(pa.array(mixed((total[at + LENGTH] - total[at]) * down[at]).view(np.int64)))
            fixed = [pa.array(np.full(len(at), int(row[c]), np.int64)) for c in ("anchor", "segment", "twin")]
            yield pa.RecordBatch.from_arrays(
                [*fixed, pa.array(at), *sums], ["anchor", "segment", "twin", "begin", "one", "two"]
            )


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(row, spans): places to remove, an array of (begin, stop), from (row, text)."""
    dealt = rows.mapInArrow(_segment_rows, "anchor long, segment long, row long, first long, n long")
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor", "segment", "row", "first")
    members = stored(
        dealt.mapInArrow(
            _repeated_rows, "anchor long, segment long, row long, first long, n long, lead boolean, twin boolean, kind long"
        ),
        "segments",
    )
    shown = members.filter("lead")
    large = cut_lineage(shown.filter(F.col("kind") == MOST_SEGMENTS).select("anchor").distinct())
    wanted = (
        shown.groupBy(F.col("row").alias("asked"))
        .agg(F.collect_list(F.struct("anchor", "segment", "first", "n", "twin")).alias("wanted"))
    )
    cut = rows.join(wanted, rows["row"] == F.col("asked")).select("text", "wanted")
    cut = cut.mapInArrow(_cut_segments, "anchor long, segment long, twin boolean, bytes binary")
    kind = "anchor long, segment long, begin long, stop long"
    if large.isEmpty():
        runs = cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted_buffers, kind)
    else:
        cut = stored(cut, "segment-bytes")
        small = cut.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
        strings = cut.join(large, "anchor", "left_semi").mapInArrow(
            _strings, "anchor long, segment long, twin long, begin long, one long, two long"
        )
        again = strings.groupBy("one", "two").agg(F.sum(F.col("twin") + 1).alias("times")).filter("times > 1").select("one", "two")
        single = strings.join(again, ["one", "two"]).select(
            "anchor", "segment", "begin", (F.col("begin") + LENGTH).alias("stop")
        )
        runs = small.mapInArrow(_sorted_buffers, kind).unionByName(single)
    spans = members.join(stored(runs, "runs"), ["anchor", "segment"]).select(
        "row", F.struct((F.col("first") + F.col("begin")).alias("begin"), (F.col("first") + F.col("stop")).alias("stop")).alias("span")
    )
    return spans.groupBy(F.col("row").alias("spans_of")).agg(F.collect_list("span").alias("spans"))


def merged_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    merged: list[list[int]] = []
    for begin, stop in sorted((s["begin"], s["stop"]) for s in spans or ()):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(stop, merged[-1][1])
        else:
            merged.append([begin, stop])
    return [(a, b) for a, b in merged]


def cut_out(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    kept, at, gone = [], 0, merged_spans(spans)
    for begin, stop in gone:
        kept.append(text[at:begin])
        at = stop
    return b"".join([*kept, text[at:]]), len(gone)


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures and the rest of each text."""
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    for batch in batches:
        found = []
        for own, spans in zip(batch.column("text").cast(pa.binary()), batch.column("spans").to_pylist()):
            text = own.as_py() or b""
            rest, runs = cut_out(text, spans)
            shown = rest.decode(errors="ignore") if own.is_valid else None
            found.append((shown, len(text), len(text) - len(rest), runs, sha256(rest).hexdigest()))
        columns = [pa.array(c, t) for c, t in zip([*zip(*found)] if found else [()] * 5, types)]
        names = ["doc_id", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def _rest(text: pa.Array, spans: pa.Array) -> pa.Array:
    rests = (cut_out(t.as_py(), s)[0] for t, s in zip(text.cast(pa.binary()), spans.to_pylist()))
    return pa.array([rest.decode(errors="ignore") for rest in rests], pa.string())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of every row.

    ``kept_text`` leaves out halves of characters that a removed span has cut.
    """
    rows = as_table(docs, doc_id=id_col, text=text_col)
    rows = rows.withColumn("row", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    spans = repeated_spans(rows.filter(F.length("text") > 0).select("row", "text"))
    joined = rows.join(spans, F.col("row") == F.col("spans_of"), "left").select(
        "doc_id", "text", "spans"
    )
    kind = dict(rows.dtypes)["doc_id"]
    figures = "kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_figures, f"doc_id {kind}, {figures}").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes gone from the text, all other columns as they are."""
    key, spans = fresh_name(docs, "spans_of"), fresh_name(docs, "cut_spans")
    row = F.xxhash64(F.col(quoted(id_col)).cast("string"), F.col(quoted(text_col)))
    rows = as_table(docs.withColumn(key, row), row=key, text=text_col).filter(F.length("text") > 0)
    found = repeated_spans(rows).select(F.col("spans_of").alias(key), F.col("spans").alias(spans))
    joined = docs.join(found, row == found[key], "left")
    kept = fresh_name(docs, "kept")
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    cut = F.arrow_udf(_rest, "string")(text, F.col(spans))
    joined = joined.withColumn(kept, F.when(F.col(spans).isNull(), F.col(quoted(text_col))).otherwise(cut))
    return replace_column(joined.drop(key, spans), text_col, kept)
