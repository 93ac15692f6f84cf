"""Documents whose sets of word shingles overlap enough, by T-occurrence search, and their groups.

A link is a Jaccard similarity of at least ``threshold`` percent. Documents with the same set are one
node from the start. The search has two steps, both exact:

* **Who is worth a search.** Sets of similar size are cut into more parts than a linked pair can have
  differing elements, by a hash of each element; so a linked pair agrees on a whole part. Rows (part's
  checksum, node) are dealt by the checksum and only parts with several nodes stay. A differing element
  spoils one part, so a linked pair agrees on as many parts with elements as there are beyond the most
  differences, less the empty ones: nodes that share fewer with all others together leave. So a frequent
  passage that fills a part of its own makes no candidates.
* **T-occurrence search.** A query's shingles have inverted lists over the documents it is compared
  with (at most ``CHUNK`` at a time). The overlap a link requires gives the number of lists a document
  must be on. The longest lists are set aside, the short ones merged with a heap that skips documents
  that cannot reach the rest, and the long ones probed by binary search (DivideSkip).

Only groups are asked for, so copies need not all be compared. Each node goes home to the smallest node
it shares a part with, which searches for it. The sets of a home are then written as differences from
the shingles that most of them have. Differences tell almost all: two sets are linked for certain if
their differences are few enough together, and then both are linked with the set that has fewest; else
they are linked only if they share differences, and how many is known. Nodes that share a part and have
neither one home nor one group yet also visit the smallest home of the part, so that all such pairs meet
in some home; there the pairs left to search share one of the rarest differences of both, early enough
for the rest to suffice. A large group of near copies thus costs its differences, not its pairs.

Shingles are compared by 64-bit hashes, sets by the sum of theirs and their size.

Defined results: null and empty texts have no shingles, size 0 and a group of their own; rows that
repeat an id each give a row, with one group; null ids are left out; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_table, fresh_name, quoted
from tidemark.llm.graph import connected_components, sorted_groups
from tidemark.llm.shingles import mixed, text_batches, text_shingles
from tidemark.sources.scratch import cut_lineage, delete, scratch_path, scratch_scope, stored, stored_at

WORDS = 5
THRESHOLD = 80
CHUNK = 256
DIFFERENCE_TURNS = 4
#: Pairs searched in a turn, as a multiple of the sets there are.
PAIRS_A_TURN = 4


# --- parts -----------------------------------------------------------------------------------


@cache
def bands(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest set size of each band, and for the pairs of band b with b or b + 1: parts and most differences.

    Linked sets lie in one band or in neighbouring ones. There are more parts than differences by as
    much as it takes for the empty parts of a set not to use up the surplus, but for rare sets.
    """
    lows = [1]
    while lows[-1] < 1 << 31:
        lows.append(lows[-1] * 100 // threshold + 1)
    parts, most = [], []
    for low, middle, high in zip(lows, lows[1:], lows[2:]):
        differ = (100 - threshold) * (middle - 1 + high - 1) // (100 + threshold)

        def shortfall(m: int) -> float:
            empty = m * (1 - 1 / m) ** low
            return empty + 4 * empty**0.5 + 1 - (m - differ)

        best = differ + 1
        for m in range(differ + 1, differ + 10 + differ // 2):
            if shortfall(m) < shortfall(best):
                best = m
            if shortfall(best) <= 0 or m > 200_000:
                break
        parts.append(best)
        most.append(differ)
    return np.array(lows[:-2]), np.array(parts), np.array(most)


def set_numbers(sets: list[np.ndarray]) -> np.ndarray:
    """One number for each set, the same for the same set."""
    sums = [mixed(s).sum(dtype=np.uint64) for s in sets]
    sizes = np.fromiter(map(len, sets), np.uint64, len(sets))
    return mixed(np.array(sums, np.uint64) + mixed(sizes)).view(np.int64)


def part_rows(sets: list[np.ndarray], threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(checksum of a part, position of its set) for all parts that linked sets could agree on."""
    return parts_and_needs(sets, threshold)[:2]


def parts_and_needs(sets: list[np.ndarray], threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``part_rows``, and on how many of these parts the set agrees at least with any set it is linked with.

    A set is cut in two ways, for its band and the one above or below; the need counts for either alone. It is
    given doubled, plus 1 in one of the two ways.
    """
    lows, parts, most = bands(threshold)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    spread = mixed(values + np.uint64(0x5851F42D4C957F2D))
    found = []
    band = np.searchsorted(lows, np.maximum(sizes, 1), side="right") - 1
    for pair in (band, band - 1):
        usable = (sizes > 0) & (pair >= 0)
        m = np.where(usable, parts[np.maximum(pair, 0)], 0)
        differ = most[np.maximum(pair, 0)]
        m[differ == 0] = 0  # only equal sets can be linked
        base = np.cumsum(m) - m
        chosen = m[owner] > 0
        at = base[owner[chosen]] + (spread[chosen] % m[owner[chosen]].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(m.sum()), np.uint64)
        np.add.at(sums, at, values[chosen])
        full = np.bincount(at, minlength=len(sums)) > 0
        holder = np.repeat(np.arange(len(sets)), m)
        empty = np.bincount(holder[~full], minlength=len(sets))
        rare = empty >= m - differ  # all its agreeing parts might be empty ones
        keep = full | rare[holder]
        place = (np.arange(len(sums)) - base[holder]).astype(np.uint64)
        key = mixed(mixed(place + (pair[holder].astype(np.uint64) << np.uint64(40))) + sums)
        need = 2 * np.maximum(1, m - differ - empty) + (pair & 1)
        found.append((key[keep].view(np.int64), holder[keep], need[holder[keep]].astype(np.int32)))
    keys, holders, needs = (np.concatenate(column) for column in zip(*found))
    return keys, holders, needs


# --- the search ------------------------------------------------------------------------------


def divide_skip(lists: list[list[int]], required: int) -> list[tuple[int, int]]:
    """(document, lists it is on) for documents on at least ``required`` of the sorted lists."""
    lists = sorted(filter(None, lists), key=len)
    if len(lists) < required:
        return []
    longest = len(lists[-1])
    n_long = min(required - 1, int(required / (0.01 * longest.bit_length() + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    least = required - n_long
    heap = [(entries[0], i, 0) for i, entries in enumerate(short)]
    heapq.heapify(heap)
    found = []
    while len(heap) >= least:
        document, popped = heap[0][0], []
        while heap and heap[0][0] == document:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            total = len(popped)
            for entries in long:
                at = bisect_left(entries, document)
                total += at < len(entries) and entries[at] == document
            if total >= required:
                found.append((document, total))
            target = document + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(short[i], target, at)
            if at < len(short[i]):
                heapq.heappush(heap, (short[i][at], i, at))
    return found


def search(query: np.ndarray, sets: list[np.ndarray], threshold: int) -> list[int]:
    """Positions of the sets that are linked with the query."""
    if not sets or not len(query):
        return []
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(query, values), len(query) - 1)
    on = query[at] == values
    order = np.argsort(at[on], kind="stable")
    at, owner = at[on][order], owner[on][order].tolist()
    bounds = np.searchsorted(at, np.arange(len(query) + 1)).tolist()
    lists = [owner[a:b] for a, b in zip(bounds, bounds[1:])]
    smallest = min(map(len, sets))
    required = max(-(-threshold * (len(query) + smallest) // (100 + threshold)), -(-threshold * len(query) // 100))
    return [
        document
        for document, shared in divide_skip(lists, required)
        if 100 * shared >= threshold * (len(query) + len(sets[document]) - shared)
    ]


# --- Spark jobs ------------------------------------------------------------------------------


def _sizes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches):
            sets = text_shingles(texts, words)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            numbers = pa.array(set_numbers(sets), pa.int64(), mask=np.array([not len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays([ids, sizes, numbers], ["id", "n", "node"])

    return run


def _parts(words: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task give their parts once
        for _, texts in text_batches(batches):
            sets = text_shingles(texts, words)
            numbers = set_numbers(sets)
            new = []
            for i, number in enumerate(numbers.tolist()):
                if number not in seen:
                    seen.add(number)
                    new.append(i)
            keys, owner, needs = parts_and_needs([sets[i] for i in new], threshold)
            nodes = numbers[np.array(new, np.int64)][owner] if new else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes), pa.array(needs)], ["part", "node", "need"])

    return run


def _shared_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (part, node), the distinct rows of parts with several nodes."""
    part, node, need, out = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), False  # the last row so far
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = np.concatenate([part, batch.column("part").to_numpy()])
        nodes = np.concatenate([node, batch.column("node").to_numpy()])
        needs = np.concatenate([need, batch.column("need").to_numpy()])
        first = np.ones(len(parts), bool)
        first[1:] = (parts[1:] != parts[:-1]) | (nodes[1:] != nodes[:-1])
        carried = len(part)
        parts, nodes, needs = parts[first], nodes[first], needs[first]
        same = np.zeros(len(parts) + 1, bool)
        same[1:-1] = parts[1:] == parts[:-1]
        several = same[1:] | same[:-1]
        if carried and out:
            several |= parts == parts[0]
            several[0] = False  # given already
        last_given = bool(several[-1]) or (carried and out and len(parts) == 1)
        yield pa.RecordBatch.from_arrays([pa.array(c[several]) for c in (parts, nodes, needs)], ["part", "node", "need"])
        part, node, need, out = parts[-1:], nodes[-1:], needs[-1:], bool(last_given)


def _links(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for (query, _), rows in sorted_groups(batches, "query", "chunk"):
            sets = {r["node"]: np.frombuffer(r["shingles"], np.uint64) for r in rows}
            own = sets.pop(query, None)
            if own is not None:
                nodes = list(sets)
                found += [(query, nodes[i]) for i in search(own, list(sets.values()), threshold)]
            if len(found) > 10_000:
                yield _link_batch(found)
                found = []
        yield _link_batch(found)

    return run


def _link_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([link[i] for link in found], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _common_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each query the shingles that most of the sets have. Any set would do; this one is near all."""
    for (query,), rows in sorted_groups(batches, "query"):
        values, counts = np.unique(np.concatenate([np.frombuffer(r["shingles"], np.uint64) for r in rows]), return_counts=True)
        most = values[2 * counts > len(rows)].tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([query]), pa.array([most], pa.binary())], ["query", "shingles"])


def _differences(threshold: int):
    """For each set of a home its differences from the common shingles. Two sets are certainly linked if
    their ``surplus`` is at most 0 together, whatever they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (query, _), rows in sorted_groups(batches, "query", "chunk"):
            sets = {r["node"]: np.frombuffer(r["shingles"], np.uint64) for r in rows}
            common = sets.pop(None)
            away = [np.setxor1d(common, s, assume_unique=True).view(np.int64) for s in sets.values()]
            surplus = [len(d) * (100 + threshold) - (100 - threshold) * len(s) for d, s in zip(away, sets.values())]
            columns = [
                pa.array([query] * len(sets), pa.int64()), pa.array(list(sets), pa.int64()), pa.array(surplus, pa.int64()),
                pa.array(away, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query", "node", "surplus", "away"])

    return run


def _in_chunks(pairs: DataFrame) -> DataFrame:
    """(query, node, chunk): the documents of a query in chunks of about ``CHUNK``."""
    many = pairs.groupBy("query").agg(F.count("*").alias("n"))
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / CHUNK)).cast("int")
    return pairs.join(many, "query").select("query", "node", chunk.alias("chunk"))


def _searched(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The links among (query, node) pairs."""
    tasks = _in_chunks(pairs)
    asked = tasks.select("query", F.col("query").alias("node"), "chunk").distinct()
    rows = tasks.unionByName(asked).join(sets, "node").repartition("query", "chunk").sortWithinPartitions("query", "chunk")
    return cut_lineage(rows.mapInArrow(_links(threshold), "a long, b long"))


def _searched_in_turns(pairs: DataFrame, sets: DataFrame, threshold: int, nodes: int) -> DataFrame:
    """``_searched`` for any number of stored pairs. A turn moves a few times as many sets as there are nodes, and they
    are gone before the next one's move; so what lies on disk at a time follows the sets, not the pairs."""
    turns = max(1, math.ceil(pairs.count() / max(1, PAIRS_A_TURN * nodes)))
    turn = F.pmod(F.xxhash64("query"), F.lit(turns))
    found = [_searched(pairs.filter(turn == i) if turns > 1 else pairs, sets, threshold) for i in range(turns)]
    return reduce(DataFrame.union, found)


def _common_sets(homes: DataFrame, sets: DataFrame) -> DataFrame:
    """(query, shingles): of each home the shingles that most of its first chunk's sets have."""
    rows = _in_chunks(homes).filter("chunk = 0").join(sets, "node").select("query", "shingles")
    rows = rows.repartition("query").sortWithinPartitions("query")
    return rows.mapInArrow(_common_shingles, "query long, shingles binary")


def _home_differences(homes: DataFrame, sets: DataFrame, common: DataFrame, threshold: int) -> DataFrame:
    """(query, node, surplus, away) of every (query, node): the node's set against its home's common shingles."""
    tasks = _in_chunks(homes)
    rows = tasks.join(sets, "node").select("query", "chunk", "node", "shingles")
    chunks = tasks.select("query", "chunk").distinct().join(common, "query")
    chunks = chunks.select("query", "chunk", F.lit(None).cast("long").alias("node"), "shingles")
    both = rows.unionByName(chunks).repartition("query", "chunk").sortWithinPartitions("query", "chunk")
    return both.mapInArrow(_differences(threshold), "query long, node long, surplus long, away array<long>")


def _grouped(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the ``component`` of their node."""
    groups = connected_components(links)
    return rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def shingle_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD
) -> DataFrame:
    """(id, n_shingles, component_id): the smallest id each document is linked with, directly or not.

    Computed when called. What is stored on the way is deleted as soon as no later step reads it; two narrow tables
    stay, which the result reads: a row per document, and a row per node that is linked.
    """
    rows = as_table(docs, id=id_col, text=text_col).filter("id is not null")
    spark, kind = rows.sparkSession, dict(rows.dtypes)["id"]
    members_path, grouped_path = scratch_path(spark, "shingle-sets"), scratch_path(spark, "shingle-groups")
    with scratch_scope(spark):
        members = stored_at(rows.mapInArrow(_sizes(words), f"id {kind}, n long, node long"), members_path)
        nodes = members.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"))
        groups = connected_components(_linked_nodes(rows, nodes, words, threshold))
        least = nodes.join(groups, "node").groupBy("component").agg(F.min("id").alias("component_id"))
        named = groups.join(least, "component").select(F.col("node").alias("grouped"), "component_id")
        named = nodes.join(named, F.col("node") == F.col("grouped"), "left").select(
            F.col("node").alias("grouped"), F.coalesce("component_id", "id").alias("component_id")
        )
        named = stored_at(named, grouped_path)
    return members.join(named, F.col("node") == F.col("grouped"), "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def _parts_of_several(parts: DataFrame) -> DataFrame:
    """The distinct (part, node, need) rows of parts with several nodes."""
    dealt = parts.repartition("part").sortWithinPartitions("part", "node")
    return dealt.mapInArrow(_shared_parts, "part long, node long, need int")


def _of_enough_parts(parts: DataFrame) -> DataFrame:
    """The rows of nodes that share as many parts as they need for a link, counted for either way of cutting."""
    counted = parts.withColumn("shared", F.count("*").over(Window.partitionBy("node", "need")))
    return counted.filter(F.col("shared") >= F.shiftright("need", 1)).drop("shared")


def _linked_nodes(rows: DataFrame, nodes: DataFrame, words: int, threshold: int) -> DataFrame:
    """Links (a, b) that join all nodes of a group."""
    spark = rows.sparkSession
    parts = _parts_of_several(rows.mapInArrow(_parts(words, threshold), "part long, node long, need int"))
    parts = stored(_parts_of_several(_of_enough_parts(stored(parts, "met-parts"))).drop("need"), "shared-parts")
    wanted = parts.select("node").distinct().join(nodes, "node")
    sets = stored(
        rows.join(wanted, "id").select("id", "text").mapInArrow(_set_rows(words), "node long, shingles binary"), "sets"
    ).dropDuplicates(["node"])  # ids may repeat
    heads = parts.groupBy("part").agg(F.min("node").alias("query"))
    homes = cut_lineage(parts.join(heads, "part").groupBy("node").agg(F.min("query").alias("query")))
    homes = homes.select("query", "node")
    common_path, away_path, guests_path, differing_path = (
        scratch_path(spark, name) for name in ("common", "away", "guests", "differing")
    )
    n_nodes = homes.count()
    common = stored_at(_common_sets(homes, sets), common_path)
    away = stored_at(_home_differences(homes, sets, common, threshold), away_path)
    least = cut_lineage(away.groupBy("query").agg(F.min(F.struct("surplus", "node")).alias("least")))
    links = _searched(homes.filter("query <> node"), sets, threshold).union(_certain(away, least))
    with scratch_scope(spark):
        visits = cut_lineage(_visits(parts, _grouped(homes, links)))
        guests = stored_at(_home_differences(visits, sets, common, threshold), guests_path)
    delete(spark, common_path)
    links = links.union(_certain(guests, least))
    with scratch_scope(spark):
        members = away.unionByName(guests)
        narrow = cut_lineage(_grouped(members.select("query", "node"), links))
        apart = narrow.groupBy("query").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        apart = apart.filter("low <> high").select("query")
        differing = stored_at(members.join(apart, "query", "left_semi"), differing_path)
        delete(spark, away_path)
        delete(spark, guests_path)
    for candidates in (_stars, _pairs_apart):
        pairs_path = scratch_path(spark, "pairs")
        with scratch_scope(spark):
            placed = stored(_grouped(differing, links).select("query", "node", "surplus", "away", "component"), "placed")
            turn = F.pmod(F.xxhash64("query"), F.lit(DIFFERENCE_TURNS))  # homes are apart from each other
            found = []
            for i in range(DIFFERENCE_TURNS):
                rarest = stored(_rarest_differences(placed.filter(turn == i), threshold), "rarest")
                found.append(stored(candidates(rarest, threshold).distinct(), "found"))
            pairs = stored_at(reduce(DataFrame.union, found).distinct(), pairs_path)
        links = links.union(_searched_in_turns(pairs, sets, threshold, n_nodes))
    return links


def _certain(away: DataFrame, least: DataFrame) -> DataFrame:
    """Links (a, b) of sets with the one of their home that differs least, where the differences are few enough."""
    sure = away.select("query", "node", "surplus").join(least, "query").filter(
        (F.col("node") != F.col("least.node")) & (F.col("surplus") + F.col("least.surplus") <= 0)
    )
    return cut_lineage(sure.select(F.col("least.node").alias("a"), F.col("node").alias("b")))


def _visits(parts: DataFrame, placed: DataFrame) -> DataFrame:
    """(query, node): the nodes of a part that lies in several homes and components visit the smallest home.

    So any two nodes of different components that share a part meet in a home.
    """
    rows = parts.join(placed, "node")
    several = rows.groupBy("part").agg(
        F.min("query").alias("home"), F.max("query").alias("last"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    several = several.filter("home <> last and low <> high").select("part", "home")
    visits = rows.join(several, "part").filter("query <> home")
    return visits.select(F.col("home").alias("query"), "node").distinct()


def _enough(one: str, other: str, threshold: int) -> Column:
    """Whether two sets whose first difference in common this is may be linked."""
    most = (1 + F.least(f"{one}.after", f"{other}.after")) * (2 * (100 + threshold))
    return most >= F.col(f"{one}.surplus") + F.col(f"{other}.surplus")


def _stars(rarest: DataFrame, threshold: int) -> DataFrame:
    """(query, node): for each of the rarest differences its set with the least surplus and those of other components."""
    head = F.min(F.struct("surplus", "node", "component", "after")).alias("head")
    heads = rarest.groupBy("query", "part").agg(head, F.min("component").alias("low"), F.max("component").alias("high"))
    heads = heads.filter("low <> high").select("query", "part", "head")
    stars = rarest.alias("set").join(heads, ["query", "part"])
    stars = stars.filter((F.col("set.component") != F.col("head.component")) & _enough("set", "head", threshold))
    return stars.select(F.col("head.node").alias("query"), "node")


def _pairs_apart(rarest: DataFrame, threshold: int) -> DataFrame:
    """(query, node): pairs of different components that share one of their rarest differences."""
    spread = rarest.groupBy("query", "part").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = spread.filter("low <> high").select("query", "part")
    rows = rarest.join(spread, ["query", "part"], "left_semi")
    a, b = rows.alias("a"), rows.alias("b")
    same = (F.col("a.query") == F.col("b.query")) & (F.col("a.part") == F.col("b.part"))
    apart = (F.col("a.component") < F.col("b.component")) & _enough("a", "b", threshold)
    return a.join(b, same & apart).select(F.col("a.node").alias("query"), F.col("b.node").alias("node"))


def _rarest_differences(away: DataFrame, threshold: int) -> DataFrame:
    """(query, node, component, part, surplus, after): of each set the rarest differences, as many as a link
    must show in, and how many more follow each.

    Linked sets of different groups share at least half their surplus over ``100 + threshold``
    differences; so one of them is among the rarest of both, all but that number.
    """
    away = away.filter("size(away) > 0")
    first = away.groupBy("query").agg(F.min(F.struct("surplus", "component")).alias("first"))
    with_first = away.join(first, "query")
    second = with_first.filter(F.col("component") != F.col("first.component")).groupBy("query")
    second = second.agg(F.min("surplus").alias("second"))  # homes of one group have none and leave
    other = F.when(F.col("component") == F.col("first.component"), F.col("second")).otherwise(F.col("first.surplus"))
    shared = F.greatest(F.ceil((F.col("surplus") + other) / (2 * (100 + threshold))), F.lit(1))
    wanted = with_first.join(second, "query").withColumn("shown", F.size("away") - shared + 1).filter("shown > 0")
    listed = wanted.select("query", "node", "component", "surplus", "shown", F.size("away").alias("n_away"), F.explode("away").alias("part"))
    # What stands in one set alone leads to no pair: it comes first in the set's order, and is not listed.
    often = stored(listed.groupBy("query", "part").agg(F.count("*").alias("n")).filter("n > 1"), "often")
    of_set = Window.partitionBy("query", "node")
    alone = F.col("n_away") - F.count("*").over(of_set)
    rank = alone + F.row_number().over(of_set.orderBy("n", "part"))
    ranked = listed.join(often, ["query", "part"]).withColumn("rank", rank).withColumn("after", F.col("n_away") - F.col("rank"))
    return ranked.filter("rank <= shown").select("query", "node", "component", "part", "surplus", "after")


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_batches(batches):
            sets = text_shingles(texts, words)
            data = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(set_numbers(sets)), data], ["node", "shingles"])

    return run


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD
) -> DataFrame:
    """The documents with the smallest id of their group; rows with a null id stay."""
    groups = shingle_groups(docs, id_col, text_col, words, threshold)
    key = fresh_name(docs, "dropped")
    dropped = groups.filter("component_id <> id").select(F.col("id").alias(key)).distinct()
    return docs.join(dropped, docs[quoted(id_col)] == dropped[key], "left_anti")
