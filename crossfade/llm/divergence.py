"""How sources of one language differ in their vocabulary: single-pass in-memory indexing, then pair corrections.

1. Blocks: a task reads its documents once and adds up postings (term, language, group, count, documents), where
   a group is a language and source. When they fill their memory, they are spilled as a run sorted by term,
   cut into chunks by the hash shard of the term.
2. Merge: a shard's chunks come in the order of their first terms. A heap of the open ones tells which is
   done first; as soon as they fill their memory, everything below the first term still to come is final and is
   added up. So a term that stands in every run costs one posting for each run and group, and no task holds
   more than the chunks that overlap. Terms in fewer than ``least`` documents of a language go.
3. A term's rate in a group is p = 1 + floor(10^9 (count + 2) / (N + 2 V)). Two groups g, h of a language differ by
   the sum of f = floor((p - q)^2 / (p + q)) over all V kept terms. A term that neither has counts f0(g, h), so
   the sum starts at V f0. Corrections for terms that one group has and the other may have or not follow from how
   many terms the group has of each count. Terms that both have are streamed, a term's groups at a time, and
   what they add for each pair is summed in the task; so no pair of postings is ever a row.

All numbers are whole. Null text, language and source are read as ''. A group without terms takes part with
its counts of 0, and a language without kept terms has values of 0. Repeated rows count as documents each. Languages
and groups are told apart by 64-bit hashes on the way, and by their names in the result.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossfade.llm.tables import materialize, small_side
from crossfade.llm.words import LOWER, find_words, hash_spans, hash_sums, ragged, text_blocks

BLOCK = 24 << 20  # bytes of postings a task adds up before it spills a run
OPEN = 24 << 20  # bytes of chunks a merging task holds before it settles what is final
CHUNK = 4096  # postings in one chunk
PAIRS = 1 << 20  # pairs a streaming task sums up before it hands them on
ONE = 1_000_000_000

# [^\x00-\x40\x5B-\x60\x7B-\x7F]+ : ASCII letters and all bytes of other scripts
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = True
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True

_KEYS = ("lang_id", "group_id")
_VALUES = ("count", "documents")
_POSTINGS = pa.schema([("term", pa.string()), *((name, pa.int64()) for name in (*_KEYS, *_VALUES))])
_CHUNKS = "shard int, first string, terms array<string>, lang_ids array<long>, group_ids array<long>, counts array<long>, documents array<long>"


def _add_up(postings: pa.Table) -> pa.Table:
    """One row for each term, language and group, sorted by the bytes of the term, then by the two numbers."""
    if not postings.num_rows:
        return postings
    coded = postings.column("term").combine_chunks().dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    sorted_terms = pc.sort_indices(coded.dictionary.cast(pa.binary()))
    rank[sorted_terms.to_numpy()] = np.arange(len(rank))
    keys = [rank[coded.indices.to_numpy()], *(postings.column(name).to_numpy() for name in _KEYS)]
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    starts = np.flatnonzero(new)
    columns = [coded.dictionary.take(sorted_terms).take(pa.array(keys[0][starts]))]
    columns += [pa.array(key[starts]) for key in keys[1:]]
    columns += [pa.array(np.add.reduceat(postings.column(name).to_numpy()[order], starts)) for name in _VALUES]
    return pa.table(columns, schema=_POSTINGS)


def _block_postings(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, groups: np.ndarray) -> pa.Table:
    """The postings of some texts: data and offsets of their bytes, the language and group of each."""
    words = find_words(data, offsets, LETTER)
    inside = LOWER[data[LETTER[data]]]  # the letters of all words, one word after another
    ends = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(words.start), pa.py_buffer(ends), pa.py_buffer(inside)).dictionary_encode()
    # a text has one group: count by text and term, then each of these is one document
    pair, count = np.unique(words.row * len(terms.dictionary) + terms.indices.to_numpy(), return_counts=True)
    row, term = np.divmod(pair, max(len(terms.dictionary), 1))
    one = np.ones(len(pair), np.int64)
    columns = [terms.dictionary.take(pa.array(term)), langs[row], groups[row], count.astype(np.int64), one]
    return _add_up(pa.table(columns, schema=_POSTINGS))


def _shards(terms: pa.Array, shards: int) -> np.ndarray:
    _, ends, data = terms.buffers()
    ends = np.frombuffer(ends, np.int32)[terms.offset : terms.offset + len(terms) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    ends -= ends[0]
    return (hash_spans(hash_sums(data, False), ends[:-1], ends[1:]) % np.uint64(shards)).astype(np.int32)


def _chunks(run: pa.Table, shards: int) -> Iterator[pa.RecordBatch]:
    """A run's chunks by shard, sorted by term within each."""
    shard = _shards(run.column("term").combine_chunks(), shards)
    order = np.argsort(shard, kind="stable")
    run, shard = run.take(pa.array(order)).combine_chunks(), shard[order]
    cuts = np.flatnonzero(np.diff(shard)) + 1
    bounds = [0, *cuts, len(shard)]
    starts = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(bounds, bounds[1:])])
    ends = pa.array(np.append(starts, len(shard)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, column.combine_chunks()) for column in run.columns]
    first = run.column("term").combine_chunks().take(pa.array(starts))
    names = ["shard", "first", "terms", "lang_ids", "group_ids", "counts", "documents"]
    yield from pa.table([pa.array(shard[starts]), first, *lists], names=names).to_batches(max_chunksize=256)


def spilled_runs(docs: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """The chunks of all runs; docs has text, lang_id and group_id."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            langs, groups = (batch.column(i).to_numpy() for i in (1, 2))
            for first, data, offsets in text_blocks(batch.column(0)):
                last = first + len(offsets) - 1
                parts.append(_block_postings(data, offsets, langs[first:last], groups[first:last]))
                held += parts[-1].nbytes
                if held > block:
                    parts = [_add_up(pa.concat_tables(parts))]
                    held = parts[0].nbytes
                    if 2 * held > block:
                        yield from _chunks(parts[0], shards)
                        parts, held = [], 0
        if parts and (run := _add_up(pa.concat_tables(parts))).num_rows:
            yield from _chunks(run, shards)

    return docs.select("text", "lang_id", "group_id").mapInArrow(index, _CHUNKS)


def _postings_of(batch: pa.RecordBatch, i: int) -> pa.Table:
    return pa.table([batch.column(k)[i].values for k in range(2, 7)], schema=_POSTINGS)


def _lists_by_term(final: pa.Table, least: int) -> pa.RecordBatch:
    """One row for each term and language: its groups and their counts; terms of few documents go."""
    terms = final.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    langs = final.column("lang_id").to_numpy()
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (langs[1:] != langs[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(terms)))
    kept = np.add.reduceat(final.column("documents").to_numpy(), starts) >= least
    starts, lengths = starts[kept], lengths[kept]
    inside = ragged(starts, lengths)
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(final.column(n).to_numpy()[inside])) for n in ("group_id", "count")]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs[starts]), final.column("term").combine_chunks().take(pa.array(starts)), *lists],
        names=["lang_id", "term", "group_ids", "counts"],
    )


def merge_runs(chunks: DataFrame, shards: int, least: int, open_bytes: int = OPEN) -> DataFrame:
    """(lang_id, term, group_ids, counts) of the terms in at least ``least`` documents of a language."""

    def settle(heap: list, below: bytes | None) -> Iterator[pa.RecordBatch]:
        """Take the postings of terms below this one (None: all) off the open chunks and add them up."""
        done = []
        while heap and (below is None or heap[0][0] < below):
            done.append(heapq.heappop(heap)[2])
        for k, (last, number, chunk) in enumerate(heap):
            terms = chunk.column("term").combine_chunks().cast(pa.binary())
            upto = pc.sum(pc.less(terms, pa.scalar(below, pa.binary()))).as_py() or 0
            if upto:
                done.append(chunk.slice(0, upto))
                heap[k] = (last, number, chunk.slice(upto))
        if done and (rows := _lists_by_term(_add_up(pa.concat_tables(done)), least)).num_rows:
            yield from pa.Table.from_batches([rows]).to_batches(max_chunksize=2048)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap: list[tuple[bytes, int, pa.Table]] = []
        shard, held, limit, number = None, 0, open_bytes, 0
        for batch in batches:
            for i, (own, first) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if own != shard:
                    yield from settle(heap, None)
                    shard, held, limit = own, 0, open_bytes
                elif held > limit:
                    yield from settle(heap, first.encode())
                    held = sum(chunk.nbytes for _, _, chunk in heap)
                    limit = max(open_bytes, 2 * held)  # all that is left may overlap the next term
                chunk = _postings_of(batch, i)
                heapq.heappush(heap, (chunk.column("term")[-1].as_py().encode(), number, chunk))
                held, number = held + chunk.nbytes, number + 1
        yield from settle(heap, None)

    dealt = chunks.repartition(shards, "shard").sortWithinPartitions("shard", "first")
    return dealt.mapInArrow(merge, "lang_id long, term string, group_ids array<long>, counts array<long>")


def _rate(count: Column, rows: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (rows + 2 terms)); whole numbers of any size that can occur."""
    above = (count + F.lit(2)).cast("decimal(28,0)") * F.lit(ONE).cast("decimal(10,0)")
    below = (rows + F.lit(2) * terms).cast("decimal(28,0)")
    return F.when(terms > 0, F.call_function("div", above, below).cast("long") + 1)


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q).cast("long")


def pair_corrections(lists: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, b, value), a < b: for each two groups, the sum over the terms that both have of
    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). ``lists`` has a term's group_ids (ascending), rates p and rates p0 without it."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def add_up(parts: list) -> tuple[np.ndarray, ...]:
        a, b, value = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((b, a))
        a, b, value = a[order], b[order], value[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        starts = np.flatnonzero(new)
        return a[starts], b[starts], np.add.reduceat(value, starts)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def rows(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in part], names=["a", "b", "value"])

        for batch in batches:
            ids, p, p0 = (batch.column(i) for i in range(3))
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
            ids, p, p0 = (x.flatten().to_numpy() for x in (ids, p, p0))
            after = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(ids)) - 1  # groups that follow in the same list
            upto = np.concatenate([[0], np.cumsum(after)])
            i = 0
            while i < len(ids):
                # some hundred thousand pairs at a time, or all of one posting
                j = max(i + 1, int(np.searchsorted(upto, upto[i] + (pairs >> 2), "right")) - 1)
                left = np.repeat(np.arange(i, j), after[i:j])
                right = ragged(np.arange(i, j) + 1, after[i:j])
                i = j
                if not len(left):
                    continue
                value = f(p[left], p[right]) - f(p[left], p0[right]) - f(p0[left], p[right]) + f(p0[left], p0[right])
                parts.append(add_up([(ids[left], ids[right], value)]))
                held += len(parts[-1][0])
                if held > pairs:
                    parts = [add_up(parts)]
                    held = len(parts[0][0])
                    if 2 * held > pairs:
                        yield rows(parts[0])
                        parts, held = [], 0
        if parts:
            yield rows(add_up(parts))

    sums = lists.select("group_ids", "p", "p0").mapInArrow(stream, "a long, b long, value long")
    return sums.groupBy("a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = 10, ranks: int = 10, block: int = BLOCK, open_bytes: int = OPEN) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: the language's other sources by how much they differ.
    Part ``term``: the first ``ranks`` of the source's terms that are likelier there than in the language. Runs jobs."""
    spark = docs.sparkSession
    lang, source = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    named = docs.select("text", lang.alias("lang"), source.alias("source")).select(
        "*", F.xxhash64("lang").alias("lang_id"), F.xxhash64("lang", "source").alias("group_id")
    )
    groups = materialize(named.select("lang", "source", "lang_id", "group_id").distinct())
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = materialize(merge_runs(spilled_runs(named, shards, block), shards, least, open_bytes))

    lang_count = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    counts = lists.select("lang_id", "term", lang_count.alias("lang_count"), F.inline(F.arrays_zip("group_ids", "counts"))).select(
        "lang_id", "term", "lang_count", F.col("group_ids").alias("group_id"), F.col("counts").alias("count")
    )
    kept = materialize(lists.groupBy("lang_id").agg(
        F.count("*").alias("terms"), F.sum(lang_count).alias("lang_rows")
    ))
    sizes = counts.groupBy("group_id").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    known = materialize(
        groups.join(small_side(kept), "lang_id", "left").join(sizes, "group_id", "left")
        .select("lang", "source", "lang_id", "group_id", F.coalesce("terms", zero).alias("terms"),
                F.coalesce("lang_rows", zero).alias("lang_rows"), F.coalesce("n", zero).alias("n"))
        .withColumn("p0", _rate(zero, F.col("n"), F.col("terms")))
    )
    facts = known.select("group_id", "terms", "n", "lang_rows", "p0")
    rates = materialize(
        counts.join(small_side(facts), "group_id")
        .select("lang_id", "term", "group_id", "count", "p0", _rate(F.col("count"), F.col("n"), F.col("terms")).alias("p"),
                _rate(F.col("lang_count"), F.col("lang_rows"), F.col("terms")).alias("q"))
    )

    # terms that one group has, measured against the other's rate of terms it has not
    by_count = rates.groupBy("lang_id", "group_id", "p", "p0").agg(F.count("*").alias("terms"))
    others = known.select("lang_id", F.col("group_id").alias("other_id"), F.col("p0").alias("q0"))
    one_sided = (
        by_count.join(others, "lang_id").where("group_id <> other_id")
        .withColumn("value", F.col("terms") * (_gap(F.col("p"), F.col("q0")) - _gap(F.col("p0"), F.col("q0"))))
        .select(F.least("group_id", "other_id").alias("a"), F.greatest("group_id", "other_id").alias("b"), "value")
        .groupBy("a", "b").agg(F.sum("value").alias("value"))
    )
    entry = F.sort_array(F.collect_list(F.struct("group_id", "p", "p0")))
    held = rates.groupBy("lang_id", "term").agg(entry.alias("e"))
    both = pair_corrections(held.select(F.col("e.group_id").alias("group_ids"), F.col("e.p").alias("p"), F.col("e.p0").alias("p0")))
    corrections = materialize(
        one_sided.unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("more"))
    )
    other = known.select("lang_id", F.col("source").alias("item"), F.col("group_id").alias("other_id"), F.col("p0").alias("q0"))
    pairs = (
        known.join(other, "lang_id").where("group_id <> other_id")
        .withColumn("a", F.least("group_id", "other_id")).withColumn("b", F.greatest("group_id", "other_id"))
        .join(corrections, ["a", "b"], "left")
        .withColumn("base", F.when(F.col("terms") > 0, F.col("terms") * _gap(F.col("p0"), F.col("q0"))).otherwise(zero))
        .select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("base") + F.coalesce("more", zero)).alias("value"))
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    best = Window.partitionBy("group_id").orderBy(F.desc("value"), "term")
    terms = (
        rates.where("p > q").select("group_id", "term", _gap(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
        .join(small_side(known.select("group_id", "lang", "source")), "group_id")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )
    return pairs.unionByName(terms)
