"""Batched phrase search with BM25 ranking over a stored inverted index of section chunks.

The index is a table of lists, one row per (token, run of chunks) with all places of the token in the run, in parallel arrays:
the three tokens after it, its chunk and its position there.  Every token of the corpus is at one place, so the writer's work is
that of flat numbers and repeated words, not of a row per pair and chunk.  Rows are made where their chunks lie, without a shuffle or
a sort of rows: a run of chunks gives its lists in order of the token, and every list goes to the open file of its token's bucket.  A
frequent token is cut into lists by ranges of chunks.  A batch of queries reads only the buckets of its own first tokens.

All queries of a batch are answered in one pass.  A query is one phrase; equal phrases are looked up once however many queries share
them.  Phrases are cut into pieces of up to four tokens, each looked up by all its tokens, so neither a frequent word nor a
frequent pair produces candidates for a longer phrase, and pieces that line up at one start are a match.  The matches of a batch are
stored once; of them only counts and the first few of each task are shuffled.  Corpus statistics cover all versions; the filter on the
current version comes after scoring.

A batch that asks for phrases from everywhere meets every bucket.  Where no index is stored for it, :func:`scan_index` stores the
chunks alone, and the batch passes over their tokens once: a Bloom filter of its pieces keeps all other places in the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proofline.functions.sizing import BROADCAST_ROWS, fits_broadcast
from proofline.functions.tokens import TokenTables, token_tables, tokens
from proofline.session import shared_folder
from proofline.sources.sinks import remove_path

CURRENT, ALL = "current", "all"
CURRENT_K, ALL_K = 5, 10
# Parts of the index by first token; an index keeps the number it was built with.
BUCKETS = 32
# So few first tokens are also named in the filter of the scan, which then skips row groups.
NAMED_TERMS = 200

# Fixed values of the ranking function: k1, b, and the floor of the term weight.
K1, B, WEIGHT_FLOOR = 1.2, 0.75, 1e-6

_KEY = ("chunk_id", "source_path")
_RESULT = (
    "chunk_id",
    "doc_id",
    "section",
    "version",
    "effective_date",
    "is_current",
    "content",
    "source_path",
)
# Tokens of a piece at most: a pair and what follows it in the postings.
GRAM = 4
# A stored list: parallel arrays with an element per place of ``first``.  ``chunks`` counts the chunks of the run that have the
# token, in the first of its lists.
LISTS = (
    "first string, chunks long, second array<string>, third array<string>, fourth array<string>, chunk_no array<long>,"
    " token_count array<long>, is_current array<boolean>, position array<int>, bucket int"
)
# Places of one list, and of the lists that are sent from a task's Python together, at most (a list more).
LIST_PLACES, SENT_PLACES = 1 << 15, 1 << 18
# Parquet settings of the lists: their words are many and lie in small pieces, so dictionaries cost more than they save.
_WRITTEN = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}
# Repetitions of the phrase table when it is too large to broadcast: spreads a frequent piece.
_SPREAD = 4
# So many pieces of two to four tokens are sent to every task, so that only places that meet one are shuffled.
PIECE_ROWS = 1_000_000
# So many pieces' hashes are still sent to every task, to drop what no piece asks for before rows are shuffled.
GATE_ROWS = 4_000_000
# Bits of one page of the Bloom filter (what Spark's bitmap aggregate holds), bits a piece, and pages at most: 32 MB in all.
PAGE_BITS, BITS_PER_PIECE, MAX_PAGES = 32_768, 32, 8_192


@dataclass(frozen=True)
class SearchIndex:
    """An index: stored chunks with their number, lists, and one row of statistics.

    Without stored ``lists`` a batch reads the chunks' tokens instead.
    """

    chunks: DataFrame
    lists: DataFrame | None
    stats: DataFrame

    @property
    def stored(self) -> bool:
        return self.lists is not None

    @property
    def postings(self) -> DataFrame:
        """``first, second, chunk_no, token_count, is_current, positions``: a row per pair of neighbouring tokens and chunk."""
        kept = ["first", "second", "chunk_no", "token_count", "is_current"]
        return _places(self.lists).groupBy(*kept).agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def tokenized(chunks: DataFrame) -> DataFrame:
    """Chunks with their tokens and how many there are."""
    rows = chunks.withColumn("tokens", tokens(F.col("content")))
    return rows.withColumn("token_count", F.size("tokens").cast("long"))


def build_index(chunks: DataFrame, root: str, buckets: int = BUCKETS, staged: bool = False) -> SearchIndex:
    """Index every chunk of every version below ``root``.

    Chunks are numbered in the order of their ids, so that a long stands for id and path wherever rows travel or are
    ranked.  They are stored before they are put in order, because finding the ranges reads them a first time; ``staged`` says that
    they are read from a stored table already.  Lists are made from runs of consecutive chunks, each in order by itself: a run is a
    part of every bucket.  Tokens are not stored besides.
    """
    spark = chunks.sparkSession
    root = root.rstrip("/")
    stored = _number_chunks(chunks, root, staged)
    _write_by_bucket(lists_of(stored, buckets), f"{root}/postings", buckets)
    lists = spark.read.schema(LISTS).parquet(f"{root}/postings")
    corpus_stats(stored, lists).withColumn("buckets", F.lit(buckets)).write.parquet(f"{root}/stats")
    return open_index(spark, root)


def scan_index(chunks: DataFrame, root: str, buckets: int = BUCKETS, staged: bool = False) -> SearchIndex:
    """Every chunk of every version below ``root``, for one batch: its places are found among the chunks' tokens as they are read."""
    spark = chunks.sparkSession
    root = root.rstrip("/")
    stored = _number_chunks(chunks, root, staged)
    total = _token_sizes(stored).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"))
    _with_average(stored, total).withColumn("buckets", F.lit(buckets)).write.parquet(f"{root}/stats")
    return SearchIndex(stored, None, spark.read.parquet(f"{root}/stats"))


def _number_chunks(chunks: DataFrame, root: str, staged: bool) -> DataFrame:
    """The chunks in the order of their ids, with their number, read from where they are written below ``root``."""
    spark = chunks.sparkSession
    plain = chunks
    if not staged:
        chunks.write.option("compression", "zstd").parquet(f"{root}/unnumbered")
        plain = spark.read.schema(chunks.schema).parquet(f"{root}/unnumbered")
    ordered = plain.orderBy(*_KEY).withColumn("chunk_no", F.monotonically_increasing_id())
    ordered.write.option("compression", "zstd").parquet(f"{root}/chunks")
    stored = spark.read.schema(ordered.schema).parquet(f"{root}/chunks")
    if not staged:
        remove_path(spark, f"{root}/unnumbered")
    return stored


def _write_by_bucket(rows: DataFrame, path: str, buckets: int) -> None:
    """Write rows by bucket in the order they come: a task has a file of every bucket open, so rows are not sorted by bucket."""
    spark = rows.sparkSession
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    # As many as this number make Spark go on by sorting.
    spark.conf.set(writers, str(buckets + 1))
    try:
        rows.write.options(**_WRITTEN).partitionBy("bucket").parquet(path)
    finally:
        spark.conf.set(writers, before)


def open_index(spark: SparkSession, root: str) -> SearchIndex:
    """The index stored below ``root``."""
    root = root.rstrip("/")
    lists = spark.read.schema(LISTS).parquet(f"{root}/postings")
    return SearchIndex(spark.read.parquet(f"{root}/chunks"), lists, spark.read.parquet(f"{root}/stats"))


def bucket_of(first: Column, buckets: Column) -> Column:
    return F.pmod(F.crc32(F.encode(first, "UTF-8")), buckets).cast("int")


@dataclass(frozen=True)
class _Run:
    """Tokens of consecutive chunks: ``code`` is the number of a token in ``vocabulary``, ``row`` its chunk and ``place`` its place there.

    The last word of the vocabulary is none: what stands behind the end of a chunk.  ``sizes`` are the tokens of each chunk.
    """

    vocabulary: pa.Array
    code: np.ndarray
    row: np.ndarray
    place: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(contents: pa.Array, tables: TokenTables, buckets: int = 1) -> _Run:
        """The codes are in the order of bucket and word."""
        sizes, words = tables.cut(contents)
        words = words.dictionary_encode()
        by_word = pc.sort_indices(words.dictionary).to_numpy()
        if buckets > 1:
            by_word = by_word[np.argsort(_buckets_of(words.dictionary, buckets)[by_word], kind="stable")]
        rank = np.empty(len(by_word), np.int32)
        rank[by_word] = np.arange(len(by_word), dtype=np.int32)
        vocabulary = pa.concat_arrays([words.dictionary.take(pa.array(by_word)), pa.nulls(1, words.type.value_type)])
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.arange(len(row), dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
        return _Run(vocabulary, rank[words.indices.to_numpy()], row, place, sizes)

    def chunk_columns(self, batch: pa.RecordBatch, places: np.ndarray) -> list[pa.Array]:
        """``chunk_no, token_count, is_current`` at the places, of a batch of :func:`_known`."""
        row = pa.array(self.row[places])
        return [batch.column(0).take(row), pa.array(self.sizes).take(row), batch.column(1).take(row)]

    def after(self, distance: int) -> np.ndarray:
        """The code that stands so many tokens further in the same chunk."""
        found = np.full(len(self.code), len(self.vocabulary) - 1, np.int32)
        same = self.row[distance:] == self.row[: len(self.row) - distance]
        found[: len(same)][same] = self.code[distance:][same]
        return found


def _buckets_of(words: pa.Array, buckets: int) -> np.ndarray:
    """What :func:`bucket_of` gives."""
    return np.fromiter((crc32(w.encode()) % buckets for w in words.to_pylist()), np.int32, len(words))


def lists_of(stored: DataFrame, buckets: int) -> DataFrame:
    """``LISTS`` rows of the chunks: every token of a run of chunks with its places, in the order of chunks and positions.

    A chunk is one row, so its places are listed inside the task that reads it.  The lists of a run come bucket by bucket, so that the
    writer stays at one file for long.
    """
    names = [f.split()[0] for f in LISTS.split(", ")]
    shared = _shared_tables(stored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = TokenTables(*shared.value)
        for batch in batches:
            run = _Run.of(batch.column(2), rule, buckets)
            if not len(run.code):
                continue
            bucket = pa.array(_buckets_of(run.vocabulary[:-1], buckets))
            after = [run.after(d) for d in (1, 2, 3)]
            # Few enough codes are sorted by their digits.
            order = np.argsort(run.code.astype(np.uint16) if len(run.vocabulary) < 1 << 16 else run.code, kind="stable")
            code, row = run.code[order], run.row[order]
            new_word = np.r_[True, code[1:] != code[:-1]]
            heads = np.flatnonzero(new_word)
            chunks = np.add.reduceat(new_word | np.r_[True, row[1:] != row[:-1]], heads, dtype=np.int64)
            sizes = np.diff(np.r_[heads, len(order)])
            pieces = -(-sizes // LIST_PLACES)
            of = np.repeat(np.arange(len(heads)), pieces)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = heads[of] + nth * LIST_PLACES
            chunks = np.where(nth == 0, chunks[of], 0)
            ends = np.r_[starts[1:], len(order)]
            at = 0
            while at < len(starts):
                to = max(at + 1, int(np.searchsorted(ends, starts[at] + SENT_PLACES, "right")))
                here = order[starts[at] : ends[to - 1]]
                offsets = pa.array(np.r_[starts[at:to], ends[to - 1]].astype(np.int32) - np.int32(starts[at]))
                values = [
                    *(run.vocabulary.take(pa.array(a[here])) for a in after),
                    *run.chunk_columns(batch, here),
                    pa.array(run.place[here]),
                ]
                word = pa.array(code[starts[at:to]])
                lists = [pa.ListArray.from_arrays(offsets, v) for v in values]
                arrays = [run.vocabulary.take(word), pa.array(chunks[at:to]), *lists, bucket.take(word)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                at = to

    return _known(stored).mapInArrow(run, LISTS)


def _known(stored: DataFrame) -> DataFrame:
    """What passes over tokens read; a chunk of a null text has no tokens."""
    return stored.filter("content is not null").select("chunk_no", "is_current", "content")


def _shared_tables(frame: DataFrame):
    """The arrays of the rule of tokens, sent to every executor once."""
    rule = token_tables(frame.sparkSession)
    return frame.sparkSession.sparkContext.broadcast((rule.folded, rule.inside))


def _token_sizes(stored: DataFrame) -> DataFrame:
    """``tokens``: how many there are in each run of chunks."""
    shared = _shared_tables(stored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = TokenTables(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(rule.cut(batch.column(0))[0].sum())])], names=["tokens"])

    return _known(stored).select("content").mapInArrow(run, "tokens long")


def corpus_stats(chunks: DataFrame, lists: DataFrame) -> DataFrame:
    """Number of chunks, tokens, and the average chunk length; every token is at one place of the lists."""
    total = lists.agg(F.coalesce(F.sum(F.size("position").cast("long")), F.lit(0)).alias("total_tokens"))
    return _with_average(chunks, total)


def _with_average(chunks: DataFrame, total: DataFrame) -> DataFrame:
    return (
        chunks.agg(F.count(F.lit(1)).alias("chunk_count"))
        .crossJoin(total)
        .withColumn("average_tokens", F.col("total_tokens") / F.nullif("chunk_count", F.lit(0)))
    )


def term_statistics(index: SearchIndex) -> DataFrame:
    """Chunks and occurrences per term, from the lists; combined on the map side."""
    return index.lists.groupBy(F.col("first").alias("term")).agg(
        F.sum("chunks").alias("chunks"), F.sum(F.size("position")).alias("occurrences")
    )


def phrases(queries: DataFrame) -> DataFrame:
    """Queries ``query_id, query_text, search_mode`` with their phrase; blank ones drop out."""
    terms = queries.withColumn("terms", tokens(F.col("query_text")))
    return terms.filter(F.size("terms") > 0).select(
        "query_id", "search_mode", F.array_join("terms", " ").alias("phrase")
    )


def _pieces(phrase: DataFrame) -> DataFrame:
    """``phrase, piece_count, at, width, first, second, third, fourth``: every fourth token with those after it, and the last four.

    Tokens beyond a piece's ``width``, which only phrases of fewer than four have, are NULL.
    """
    terms = F.split("phrase", " ")
    n = F.size(terms)
    starts = F.when(n <= GRAM, F.array(F.lit(0))).otherwise(
        F.array_union(F.sequence(F.lit(0), F.greatest(n - GRAM, F.lit(0)), F.lit(GRAM)), F.array(n - GRAM))
    )
    names = ("first", "second", "third", "fourth")
    cut = F.transform(
        starts,
        lambda s: F.struct(s.alias("at"), *[F.get(terms, s + i).alias(name) for i, name in enumerate(names)]),
    )
    width = F.least(n, F.lit(GRAM)).alias("width")
    return phrase.select("phrase", F.size(starts).alias("piece_count"), width, F.explode(cut).alias("p")).select(
        "phrase", "piece_count", "width", "p.*"
    )


def pruned_postings(index: SearchIndex, pieces: DataFrame) -> DataFrame:
    """The lists that can meet ``pieces``: only their buckets are read, for few terms only these terms' row groups.

    What comes to the driver is a set of bucket numbers, and of terms only if there are at most ``NAMED_TERMS``.
    """
    buckets = index.stats.first()["buckets"]
    firsts = pieces.select("first", bucket_of(F.col("first"), F.lit(buckets)).alias("bucket")).distinct()
    found = firsts.agg(F.collect_set("bucket").alias("buckets"), F.count(F.lit(1)).alias("terms")).first()
    read = index.lists.filter(F.col("bucket").isin(sorted(found["buckets"])))
    if found["terms"] <= NAMED_TERMS:
        read = read.filter(F.col("first").isin(sorted(r["first"] for r in firsts.select("first").collect())))
    return read


def phrase_matches(index: SearchIndex, wanted: DataFrame) -> DataFrame:
    """``phrase, chunk_no, token_count, is_current, tf`` for a table of ``phrase``."""
    pieces = _pieces(wanted.select("phrase").distinct())
    chunk = ["phrase", "chunk_no", "token_count", "is_current"]
    whole = F.col("piece_count") == 1
    # The forms the batch has: only these read lists.
    forms = {(r["width"], r["whole"]) for r in pieces.select("width", whole.alias("whole")).distinct().collect()}
    parts = []
    # Single tokens have lists of their own; in a pass over the chunks they are met like all others.
    longer = any(width > 1 for width, _ in forms) or not index.stored
    if longer:
        # Of a piece that is the whole phrase every place counts; other pieces have to meet at one start.
        start = F.when(whole, F.lit(0)).otherwise(F.col("pos") - F.col("at"))
        met = _met_grams(index, pieces.filter("width > 1") if index.stored else pieces).withColumn("start", start)
        found = met.groupBy(*chunk, "piece_count", "start").agg(F.count(F.lit(1)).alias("found"))
        if all(alone for _, alone in forms):
            parts.append(found.select(*chunk, F.col("found").alias("tf")))
        else:
            meets = found.filter(whole | (F.col("found") == F.col("piece_count")))
            parts.append(meets.groupBy(*chunk).agg(F.sum(F.when(whole, F.col("found")).otherwise(F.lit(1))).alias("tf")))
    if index.stored and (not parts or any(width == 1 for width, _ in forms)):
        parts.append(_met_words(index, pieces.filter("width = 1")).groupBy(*chunk).agg(F.count(F.lit(1)).alias("tf")))
    # A phrase is in one of them.
    return reduce(DataFrame.unionByName, parts)


def _places(lists: DataFrame, *others: str) -> DataFrame:
    """Every place of the lists as a row; ``others`` are further columns to keep."""
    at = lambda name: F.get(name, F.col("i")).alias(name)
    return lists.select("*", F.posexplode("position").alias("i", "pos")).select(
        *others, "first", *[at(c) for c in ("second", "third", "fourth", "chunk_no", "token_count", "is_current")], "pos"
    )


def _met_words(index: SearchIndex, pieces: DataFrame) -> DataFrame:
    """Places of the phrases of one token."""
    return _places(_joined(pruned_postings(index, pieces), pieces.select("phrase", "first"), ["first"], spread=False), "phrase")


def _met_grams(index: SearchIndex, pieces: DataFrame) -> DataFrame:
    """Places ``pos`` of the pieces of up to four tokens, with their phrase, ``piece_count`` and ``at``.

    A place stands once for every width that the batch asks for, with the tokens of that width.
    """
    widths = sorted(r["width"] for r in pieces.select("width").distinct().collect())
    on = ["first", "second", "third", "fourth", "width"]
    # No token is empty: an empty one stands for none, which equals itself in a join.
    asked = pieces.fillna("", ["second", "third", "fourth"])
    if not index.stored:
        return _joined(_met_in_chunks(index, asked, widths), asked, on, max_rows=PIECE_ROWS, gated=True)
    # Most places go by their pair already, before any further token is looked at.
    pairs = _gated(_places(pruned_postings(index, pieces.select("first"))), asked, ["first", "second"])
    upto = lambda token, least: F.when(F.col("width") >= least, F.coalesce(token, F.lit(""))).otherwise(F.lit(""))
    rows = pairs.withColumn("width", F.explode(F.array(*[F.lit(w) for w in widths]))).withColumns(
        {"third": upto("third", 3), "fourth": upto("fourth", 4)}
    )
    return _joined(rows, asked, on, max_rows=PIECE_ROWS)


def _word_hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit number of every word, from its bytes; a null one has that of an empty one."""
    words = vocabulary.fill_null("")
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    found = np.zeros(len(words), np.uint64)
    if offsets[-1] > offsets[0]:
        letters = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
        sizes = np.diff(offsets)
        # Powers of an odd number by the place in the word.
        powers = np.cumprod(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
        letters *= powers[np.arange(len(letters)) - np.repeat(offsets[:-1] - offsets[0], sizes)]
        some = sizes > 0
        found[some] = np.add.reduceat(letters, (offsets[:-1] - offsets[0])[some])
    return found


def _piece_hashes(hashes: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the pieces whose tokens have these hashes, one array a token."""
    mixed = np.full(len(hashes[0]), len(hashes), np.uint64)
    for h in hashes:
        mixed = (mixed ^ h) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _filter_places(piece: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The places of pieces in a filter of ``2**bits`` bits, by their hashes; one array for each of two hash functions."""
    for factor in (1, 0xBF58476D1CE4E5B9):
        yield (piece * np.uint64(factor) >> np.uint64(64 - bits)).astype(np.int64)


def _piece_filter(asked: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of the pieces as bytes, and the power of two of its bits; at most ``MAX_PAGES`` pages come to the driver."""
    wanted = max(PAGE_BITS, min(asked.count() * BITS_PER_PIECE, PAGE_BITS * MAX_PAGES))
    bits = (wanted - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(4).to_numpy(zero_copy_only=False)
            words = [batch.column(i).dictionary_encode() for i in range(GRAM)]
            hashes = [_word_hashes(w.dictionary)[w.indices.to_numpy(zero_copy_only=False)] for w in words]
            for w in np.unique(width):
                found = _filter_places(_piece_hashes([h[width == w] for h in hashes[:w]]), bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found]))], names=["place"])

    places = asked.select("first", "second", "third", "fourth", "width").mapInArrow(run, "place long")
    pages = places.groupBy(F.expr(f"place div {PAGE_BITS}").alias("page")).agg(
        F.bitmap_construct_agg(F.col("place") % PAGE_BITS).alias("bits")
    )
    filled = np.zeros((1 << bits) // 8, np.uint8)
    size = PAGE_BITS // 8
    for row in pages.collect():
        filled[row["page"] * size : (row["page"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return filled, bits


def _met_in_chunks(index: SearchIndex, asked: DataFrame, widths: list[int]) -> DataFrame:
    """The places of all chunks that a filter of the pieces may hold, once for every width; the join that follows compares the tokens."""
    filled, bits = _piece_filter(asked)
    shared = index.chunks.sparkSession.sparkContext.broadcast(filled)
    schema = (
        "first string, second string, third string, fourth string, width int, chunk_no long, token_count long, is_current boolean, pos int"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    tables = _shared_tables(index.chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rule = shared.value, TokenTables(*tables.value)
        may_hold = lambda place: held[place >> 3] >> (place & 7).astype(np.uint8) & 1
        for batch in batches:
            run = _Run.of(batch.column(2), rule)
            hashes, none = _word_hashes(run.vocabulary), len(run.vocabulary) - 1
            words = run.vocabulary.fill_null("")
            codes = [run.code, *(run.after(d) for d in range(1, max(widths)))]
            for width in widths:
                # A piece ends within its chunk.
                at = np.flatnonzero(codes[width - 1] != none)
                piece = _piece_hashes([hashes[c[at]] for c in codes[:width]])
                at = at[np.logical_and.reduce([may_hold(place) for place in _filter_places(piece, bits)])]
                if not len(at):
                    continue
                tokens_ = [words.take(pa.array(codes[i][at] if i < width else np.full(len(at), none))) for i in range(GRAM)]
                arrays = [*tokens_, pa.array(np.full(len(at), width, np.int32)), *run.chunk_columns(batch, at)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(run.place[at])], names=names)

    return _known(index.chunks).mapInArrow(run, schema)


def _gated(rows: DataFrame, asked: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those that agree with none of ``asked`` in the columns ``on``, by hashes sent to every task."""
    gates = asked.select(F.xxhash64(*on).alias("gate")).distinct()
    if gates.count() > GATE_ROWS:
        return rows
    return rows.withColumn("gate", F.xxhash64(*on)).join(F.broadcast(gates), "gate", "left_semi").drop("gate")


def _joined(
    rows: DataFrame, asked: DataFrame, on: list[str], max_rows: int = BROADCAST_ROWS, gated: bool = False, spread: bool = True
) -> DataFrame:
    """``rows`` with the pieces that agree with them in the columns ``on``."""
    # What is measured is what would be sent: every piece carries its whole phrase.
    if fits_broadcast(asked, "phrase", max_rows=max_rows):
        return rows.join(F.broadcast(asked), on)
    # Hashes of what is asked let hardly any other row into the shuffle; the join itself compares the tokens.
    if not gated:
        rows = _gated(rows, asked, on)
    if not spread:
        return rows.join(asked, on)
    copies = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))))
    return rows.withColumn("part", F.pmod("chunk_no", F.lit(_SPREAD)).cast("int")).join(copies, [*on, "part"])


def _saturation(tf: Column, length: Column, average: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def _weight(total: Column, matching: Column) -> Column:
    raw = F.log((total - matching + 0.5) / (matching + 0.5))
    return F.when(raw <= 0, F.lit(WEIGHT_FLOOR)).otherwise(raw)


def bm25_scores(index: SearchIndex, matches: DataFrame) -> DataFrame:
    """Matches with ``bm25_score``: negative, lower is better."""
    matches = _stored(matches, "matches")
    counts = matches.groupBy("phrase").agg(F.count(F.lit(1)).alias("matching"))
    return _scored(index, _saturated(index, matches).join(counts, "phrase"))


def _saturated(index: SearchIndex, matches: DataFrame) -> DataFrame:
    average = index.stats.select("average_tokens").scalar()
    return matches.withColumn(
        "saturation", _saturation(F.col("tf"), F.col("token_count"), average)
    )


def _scored(index: SearchIndex, rows: DataFrame) -> DataFrame:
    total = index.stats.select("chunk_count").scalar()
    return rows.withColumn(
        "bm25_score", -_weight(total, F.col("matching")) * F.col("saturation")
    ).drop("saturation", "matching")


def search(
    index: SearchIndex, queries: DataFrame, current_k: int = CURRENT_K, all_k: int = ALL_K
) -> DataFrame:
    """Top chunks per query ``query_id, query_text, search_mode``; ties go by chunk id.

    The weight of a phrase is the same for all its chunks, so the top rows are chosen before the
    phrase's match count is joined on.  The limit is pushed below the exchange (each task keeps k
    rows per phrase and mode), so a phrase that occurs everywhere does not gather in one task.
    Contents are joined last, to the rows of the result.
    """
    # Stored, because the phrases are read by every step that is sized by them, the matches by two.
    asked = _stored(phrases(queries), "phrases")
    matches = _stored(phrase_matches(index, asked), "matches")
    # A match stands in every mode of the batch that it belongs to, so that no join has to bring phrases together before the limit.
    modes = [r["search_mode"] for r in asked.select("search_mode").distinct().collect()]
    belongs = [F.when(F.lit(m == ALL) | F.col("is_current"), F.lit(m)) for m in modes if m is not None]
    # Chunks are numbered in the order of their ids.
    order = Window.partitionBy("phrase", "search_mode").orderBy(F.desc(F.round("saturation", 9)), "chunk_no")
    limit = F.when(F.col("search_mode") == ALL, F.lit(all_k)).otherwise(F.lit(current_k))
    top = (
        _saturated(index, matches)
        .withColumn("search_mode", F.explode(F.array_compact(F.array(*belongs).cast("array<string>"))))
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= max(current_k, all_k))
        .filter(F.col("rank") <= limit)
    )
    counts = matches.groupBy("phrase").agg(F.count(F.lit(1)).alias("matching"))
    scored = _scored(index, top.join(counts, "phrase")).select(
        "phrase", "search_mode", "rank", "chunk_no", "bm25_score"
    )
    # Adaptive execution knows the size of the hits and broadcasts them where they are few.
    hits = asked.join(scored, ["phrase", "search_mode"]).drop("phrase")
    return hits.join(index.chunks.select("chunk_no", *_RESULT), "chunk_no").select(
        "query_id", "search_mode", "rank", *_RESULT, "bm25_score"
    )


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def named(index: SearchIndex, matches: DataFrame) -> DataFrame:
    """Matches or scores with the id and path of their chunk."""
    return matches.join(index.chunks.select("chunk_no", *_KEY), "chunk_no")


def search_current(index: SearchIndex, queries: DataFrame, top_k: int = CURRENT_K) -> DataFrame:
    """Top chunks of current versions for ``query_id, query_text``."""
    return search(index, queries.withColumn("search_mode", F.lit(CURRENT)), current_k=top_k)


def search_all(index: SearchIndex, queries: DataFrame, top_k: int = ALL_K) -> DataFrame:
    """Top chunks of all versions for ``query_id, query_text``."""
    return search(index, queries.withColumn("search_mode", F.lit(ALL)), all_k=top_k)
