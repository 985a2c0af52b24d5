"""Language identification by interpolated Kneser-Ney character models.

Texts are read as UTF-16 units: letters and marks in lower case, any run of other characters as one
space.  For each language every run of ``ORDER`` units in its training texts is counted; lower
orders count in how many different contexts a run occurs, as Kneser-Ney smoothing has it.  All
models share sorted hash arrays: one array of hashed runs per order with the interpolated log
probability under each language, and one per context length with the back-off weights.  A text goes
to the language of the lowest cross-entropy per unit.

The units of a run are packed in 64 bits, which a bijection spreads, so different runs never share
a hash.  Training counts cover all learning rows, and every run of them is in the model.  A model of
up to ``TOGETHER_VALUES`` runs times languages is sent to the tasks.  A larger one stays a table of
counts: texts are cut into chunks, the distinct runs of a chunk are joined with the table, and the
chunk is scored with what was found; the scores are the same.  More than ``MAX_LANGUAGES``
languages raise ``ValueError``.  A tenth of the learning rows is kept out of the counts and calibrates two things: the
temperature of the score, and per language the bound beyond which a text is rejected as being in no
learnt language.

Results for odd input: a null text or one without letters is ``und`` with score 0 and rejected; a
null id is never a learning row; without any learning row every text is ``und``.  Ties go to
the first language in name order.  Texts longer than ``PIECE`` characters are scored in pieces that
start anew and are summed.  Repeated rows are each returned; other columns are not read.
"""

from __future__ import annotations

import math
import pickle
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.llm.arrays import mixed
from proofline.llm.staging import stage

ORDER = 4
# Distinct runs of the highest order times languages of a model that is sent to the tasks.
TOGETHER_VALUES = 1 << 22
# Characters of a chunk that is joined with a larger model; fewer if there are many languages.
CHUNK = 1 << 23
CHUNK_VALUES = 1 << 25
MAX_LANGUAGES = 256
PIECE = 1 << 20
UNDETERMINED = "und"

# Calibration: candidate temperatures, the share of own texts within the bound, and the slack on it.
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
OWN_SHARE = 0.999
SLACK = 2.0
# Nats per unit above a language's mean that are always allowed.
LEAST_SLACK = 1.5
# Deviations shrink with the square root of a text's length up to this many units.
STEADY_UNITS = 400

_START, _SPACE = 0, 0x20
_JOIN = "￿"


def unit_table() -> np.ndarray:
    """For every UTF-16 unit what it is read as: a lower-case letter, a space, or a text's start."""
    table = np.full(1 << 16, _SPACE, np.uint16)
    for unit in range(1 << 16):
        if 0xD800 <= unit < 0xE000:
            table[unit] = unit
            continue
        char = chr(unit)
        if unicodedata.category(char)[0] in "LM":
            lower = char.lower()
            table[unit] = ord(lower) if len(lower) == 1 else unit
    table[0xFFFF] = _START
    return table


def _cut(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of at most about ``PIECE`` characters, long texts in pieces."""
    rows: list[int] = []
    parts: list[str] = []
    total = 0
    for row, text in enumerate(texts):
        for start in range(0, max(len(text), 1), PIECE):
            part = text[start : start + PIECE] if len(text) > PIECE else text
            if rows and total + len(part) > PIECE:
                yield rows, parts
                rows, parts, total = [], [], 0
            rows.append(row)
            parts.append(part)
            total += len(part)
    if rows:
        yield rows, parts


def units_of(parts: list[str], table: np.ndarray) -> np.ndarray:
    """The units of several texts in one array, each text after a start unit; ends with one, too."""
    clean = [p.replace(_JOIN, " ") if _JOIN in p else p for p in parts]
    joined = _JOIN + _JOIN.join(f" {p} " for p in clean) + _JOIN
    units = table[np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), "<u2")]
    space = units == _SPACE
    return units[~(space & np.r_[False, space[:-1]])]


def packed(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every unit but the starts: its place and it with the units before it, in 64 bits."""
    wide = units.astype(np.uint64)
    key = wide.copy()
    seen = units != _START
    alive = seen
    for back in range(1, ORDER):
        earlier = np.zeros_like(wide)
        earlier[back:] = wide[:-back]
        earlier *= alive
        alive = alive & (earlier != 0)
        key |= earlier << np.uint64(16 * back)
    places = np.flatnonzero(seen)
    return places, key[places]


def count_runs(texts: DataFrame) -> DataFrame:
    """``(lang, key, n)`` of all runs in ``(lang, text)``; each task sends every run at most once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table()
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, keys: np.ndarray, n: np.ndarray) -> None:
            if lang in counts:
                keys, n = np.r_[counts[lang][0], keys], np.r_[counts[lang][1], n]
                order = np.argsort(keys)
                keys, n = keys[order], n[order]
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                keys, n = keys[first], np.add.reduceat(n, first)
            counts[lang] = keys, n

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, n) in counts.items():
                for at in range(0, len(keys), 1 << 20):
                    part = slice(at, at + (1 << 20))
                    columns = [pa.array([lang] * len(keys[part])), pa.array(keys[part].view(np.int64)), pa.array(n[part])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "key", "n"])
            counts.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, code in zip(texts, langs) if code == lang]
                for _, parts in _cut(own):
                    _, keys = packed(units_of(parts, table))
                    if len(keys):
                        add(lang, *np.unique(keys, return_counts=True))
            if sum(len(keys) for keys, _ in counts.values()) > 4 * (1 << 20):
                yield from flush()
        yield from flush()

    found = texts.mapInArrow(run, "lang string, key long, n long")
    return found.groupBy("lang", "key").agg(F.sum("n").alias("n"))


class HashArray:
    """Values by 64-bit key: hashes in order, found through an index on their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        hashes = mixed(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        self.shift = np.uint64(64 - max(1, math.ceil(math.log2(len(keys) + 1))))
        slots = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)
        lead = self.hashes >> self.shift
        self.first = np.searchsorted(lead, slots).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, and whether it is there."""
        hashes = mixed(keys)
        lead = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        last = len(self.hashes) - 1
        open_ = np.flatnonzero((at < end) & (self.hashes[np.minimum(at, last)] < hashes))
        while len(open_):
            at[open_] += 1
            more = (at[open_] < end[open_]) & (self.hashes[np.minimum(at[open_], last)] < hashes[open_])
            open_ = open_[more]
        at = np.minimum(at, last)
        return at, self.hashes[at] == hashes


@dataclass
class Model:
    """All languages' models; ``runs[n]`` holds runs of ``n + 1`` units, ``contexts[n]`` of ``n`` units."""

    languages: list[str]
    runs: list[HashArray]
    contexts: list[HashArray]
    unseen: float

    def score(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of every key's last unit under every language."""
        total = np.zeros((len(keys), len(self.languages)), np.float32)
        left, rest = np.arange(len(keys)), keys
        for order in range(ORDER, 0, -1):
            table = self.runs[order - 1]
            at, found = table.find(rest)
            if order == ORDER:
                total = table.values[at]
                total[~found] = 0
            else:
                total[left[found]] += table.values[at[found]]
            left, rest = left[~found], rest[~found]
            if not len(left):
                return total
            if order > 1:
                weights = self.contexts[order - 1]
                at, known = weights.find(rest >> np.uint64(16))
                total[left[known]] += weights.values[at[known]]
                rest = rest & np.uint64((1 << (16 * (order - 1))) - 1)
        total[left] += np.float32(self.unseen)
        return total


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(keys) else values


def train(languages: list[str], runs: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney models from the counts of the highest order.

    ``p(w | abc) = (n(abcw) - D) / n(abc) + D * types(abc) / n(abc) * p(w | bc)``, with contexts instead
    of counts below the highest order and an even share for every known unit at the bottom.
    """
    low = [np.uint64((1 << (16 * n)) - 1) for n in range(ORDER)]
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for lang in languages:
        keys, n = runs[lang]
        levels = [_grouped(keys, n.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            longer = levels[0][0]
            levels.insert(0, _grouped(longer & low[order], np.ones(len(longer))))
        counts.append(levels)
    alphabet = len(np.unique(np.concatenate([levels[0][0] for levels in counts]))) + 1
    unions = [np.unique(np.concatenate([levels[n][0] for levels in counts])) for n in range(ORDER)]
    shares = [np.zeros((len(u), len(languages))) for u in unions]
    contexts: list[tuple[np.ndarray, np.ndarray]] = []
    below = np.full((1, len(languages)), 1 / alphabet)
    below_at = lambda keys: np.zeros(len(keys), np.int64)
    for order in range(1, ORDER + 1):
        keys = unions[order - 1]
        context_keys, context_of = np.unique(keys >> np.uint64(16), return_inverse=True)
        gammas = np.ones((len(context_keys), len(languages)))
        for column, levels in enumerate(counts):
            own, n = levels[order - 1]
            place = np.searchsorted(keys, own)
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total = np.bincount(context_of[place], n, len(context_keys))
            types = np.bincount(context_of[place], minlength=len(context_keys))
            known = total > 0
            gammas[known, column] = discount * types[known] / total[known]
            shares[order - 1][place, column] = (n - discount) / total[context_of[place]]
        shares[order - 1] += gammas[context_of] * below[below_at(keys & low[order - 1])]
        contexts.append((context_keys, gammas))
        below = shares[order - 1]
        below_at = lambda keys, u=keys: np.searchsorted(u, keys)
    with np.errstate(divide="ignore"):
        tables = [HashArray(u, np.log(s).astype(np.float32)) for u, s in zip(unions, shares)]
        weights = [HashArray(k, np.log(g).astype(np.float32)) for k, g in contexts]
    bottom = float(np.log(contexts[0][1]).mean() - math.log(alphabet))
    return Model(languages, tables, weights, bottom)


@dataclass
class Spread:
    """All languages' counts as a table, for models too large to be sent to the tasks.

    ``entries`` has ``(kind, key, found)``: of kind ``n`` the runs of ``n`` units with their counts ``a``, of
    kind ``ORDER + n`` their contexts with the sum ``a`` and the number ``b`` of what follows.
    """

    languages: list[str]
    entries: DataFrame
    discounts: np.ndarray
    alphabet: int
    unseen: float


def spread(runs: DataFrame, languages: list[str]) -> Spread:
    """The counts that ``train`` has, of all runs, without gathering them."""
    codes = F.array(*[F.lit(lang) for lang in languages])
    level = runs.select((F.array_position(codes, F.col("lang")) - 1).cast("int").alias("lang"), "key", F.col("n").cast("double").alias("n"))
    discounts = np.full((ORDER + 1, len(languages)), 0.5)
    entries: DataFrame | None = None
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            shorter = F.col("key").bitwiseAND(F.lit((1 << (16 * order)) - 1)).alias("key")
            level = stage(level.groupBy("lang", shorter).agg(F.count(F.lit(1)).cast("double").alias("n")), "level")
        few = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
        for row in few.collect():
            if row.once and row.twice:
                discounts[order, row.lang] = row.once / (row.once + 2 * row.twice)
        contexts = level.groupBy("lang", F.shiftrightunsigned("key", 16).alias("key"))
        contexts = contexts.agg(F.sum("n").alias("a"), F.count(F.lit(1)).cast("double").alias("b"))
        own = level.select(F.lit(order).alias("kind"), "key", "lang", F.col("n").alias("a"), F.lit(0.0).alias("b"))
        both = own.unionByName(contexts.withColumn("kind", F.lit(ORDER + order)))
        entries = both if entries is None else entries.unionByName(both)
    alphabet = level.select("key").distinct().count() + 1
    gammas = np.ones(len(languages))
    for row in contexts.collect():
        gammas[row.lang] = discounts[1, row.lang] * row.b / row.a
    found = entries.groupBy("kind", "key").agg(F.collect_list(F.struct("lang", "a", "b")).alias("found"))
    return Spread(languages, stage(found, "entries"), discounts, alphabet, float(np.log(gammas).mean() - math.log(alphabet)))


def model_of(found: pa.Table, languages: list[str], discounts: np.ndarray, alphabet: int, unseen: float) -> Model:
    """The part of the model that has the given entries; scores of their runs equal those of ``train``."""
    lists = found.column("found").combine_chunks()
    cells = lists.flatten()
    entry = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    kinds, keys = found.column("kind").to_numpy(), found.column("key").to_numpy().view(np.uint64)
    lang, a, b = (cells.field(n).to_numpy() for n in ("lang", "a", "b"))
    # Never a run or a context: arrays are not empty.
    none = np.full(1, (1 << 64) - 1, np.uint64)

    def of(kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of a kind in order, its cells, and the place of each cell's key."""
        own = np.flatnonzero(kinds[entry] == kind)
        union = np.unique(np.r_[keys[kinds == kind], none])
        return union, own, np.searchsorted(union, keys[entry[own]])

    tables, weights = [], []
    below, below_keys = np.full((1, len(languages)), 1 / alphabet), np.zeros(1, np.uint64)
    for order in range(1, ORDER + 1):
        discount = discounts[order]
        context_keys, own, place = of(ORDER + order)
        gammas, totals = np.ones((len(context_keys), len(languages))), np.ones((len(context_keys), len(languages)))
        gammas[place, lang[own]] = discount[lang[own]] * b[own] / a[own]
        totals[place, lang[own]] = a[own]
        union, own, place = of(order)
        context_of = np.searchsorted(context_keys, union >> np.uint64(16))
        context_of[-1] = 0
        shares = np.zeros((len(union), len(languages)))
        shares[place, lang[own]] = (a[own] - discount[lang[own]]) / totals[context_of[place], lang[own]]
        low = np.searchsorted(below_keys, union & np.uint64((1 << (16 * (order - 1))) - 1))
        low[-1] = 0
        shares += gammas[context_of] * below[low]
        tables.append(HashArray(union, np.log(shares).astype(np.float32)))
        weights.append(HashArray(context_keys, np.log(gammas).astype(np.float32)))
        below, below_keys = shares, union
    return Model(languages, tables, weights, unseen)


def wanted_keys(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Kinds and keys of all entries that scoring the given runs can need."""
    for order in range(ORDER, 0, -1):
        keys = np.unique(keys & np.uint64((1 << (16 * order)) - 1))
        yield order, keys
        yield ORDER + order, np.unique(keys >> np.uint64(16))


def scored(rows: DataFrame, text_at: int, model: Model | Spread, work: Callable, schema) -> DataFrame:
    """``work(model, batch, table)`` for all rows; the text is in column ``text_at``."""
    if isinstance(model, Model):
        shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = unit_table()
            model = pickle.loads(shared.value)
            for batch in batches:
                yield work(model, batch, table)

        return rows.mapInArrow(run, schema)

    given = (model.languages, model.discounts, model.alphabet, model.unseen)
    most = max(1, min(CHUNK, CHUNK_VALUES // len(model.languages)))
    chunk = "chunk"
    while chunk.lower() in map(str.lower, rows.columns):
        chunk += "_"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their chunk: the task's rows one after another."""
        first, total = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = np.array([len(t or "") for t in batch.column(text_at).to_pylist()], np.int64)
            ends = total + np.cumsum(sizes)
            total += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + (ends - sizes) // most)], names=[*batch.schema.names, chunk])

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table()
        at, keys = None, np.zeros(0, np.uint64)

        def told() -> Iterator[pa.RecordBatch]:
            for kind, found in wanted_keys(keys) if len(keys) else ():
                columns = [pa.array(np.full(len(found), n, t)) for n, t in ((at, np.int64), (kind, np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=["chunk", "kind", "key"])

        for batch in batches:
            chunks, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for own in np.unique(chunks):
                if own != at:
                    yield from told()
                    at, keys = int(own), np.zeros(0, np.uint64)
                for _, parts in _cut([texts[i] or "" for i in np.flatnonzero(chunks == own)]):
                    keys = np.union1d(keys, packed(units_of(parts, table))[1])
        yield from told()

    def score(found: pa.Table, own: pa.Table) -> pa.Table:
        table, local = unit_table(), model_of(found, *given)
        own = own.drop_columns([chunk]).combine_chunks()
        return pa.Table.from_batches([work(local, batch, table) for batch in own.to_batches()])

    dealt = stage(rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField(chunk, T.LongType())])), "chunks")
    texts = dealt.select(F.col(chunk).alias("chunk"), dealt[dealt.columns[text_at]].alias("text"))
    wanted = texts.mapInArrow(want, "chunk long, kind int, key long").distinct()
    found = wanted.join(model.entries, ["kind", "key"]).select("chunk", "kind", "key", "found")
    return found.groupBy("chunk").cogroup(dealt.groupBy(chunk)).applyInArrow(score, schema)


def score_texts(model: Model, texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed log probabilities per language, and the number of units; no units without a letter."""
    sums = np.zeros((len(texts), len(model.languages)))
    counts = np.zeros(len(texts), np.int64)
    letters = np.zeros(len(texts), bool)
    for rows, parts in _cut([t or "" for t in texts]):
        units = units_of(parts, table)
        places, keys = packed(units)
        starts = np.flatnonzero(units == _START)
        first = np.searchsorted(places, starts)
        rows_ = np.array(rows)
        size = np.diff(first)
        scores = model.score(keys)
        # Every part holds at least one space, so no range is empty.
        np.add.at(sums, rows_, np.add.reduceat(scores, first[:-1], axis=0, dtype=np.float64))
        np.add.at(counts, rows_, size)
        solid = np.add.reduceat((units[places] != _SPACE).astype(np.int64), first[:-1])
        np.logical_or.at(letters, rows_, solid > 0)
    counts[~letters] = 0
    return sums, counts


def learning_rows(docs: DataFrame, id_column: str, lang_column: str) -> tuple[Column, Column]:
    """Whether a row may be learnt from, and whether it calibrates; by CRC-32 of the id as text."""
    code = F.crc32(F.col(id_column).cast("string"))
    learns = F.col(lang_column).isNotNull() & F.coalesce(code % 3 != 1, F.lit(False))
    return learns, learns & (F.floor(code / 3) % 10 == 0)


@dataclass
class Calibrated:
    """A model with what its calibration rows gave."""

    model: Model | Spread
    temperature: float
    centre: np.ndarray
    bound: np.ndarray


def _judged(model: Model, texts: list[str | None], table: np.ndarray):
    sums, counts = score_texts(model, texts, table)
    entropy = -sums / np.maximum(counts, 1)[:, None]
    return sums, counts, entropy, entropy.argmin(axis=1)


def posterior(sums: np.ndarray, best: np.ndarray, temperature: float) -> np.ndarray:
    """Share of the best language when log probabilities are divided by the temperature."""
    top = sums[np.arange(len(sums)), best][:, None]
    return 1 / np.exp((sums - top) / temperature).sum(axis=1)


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", together: int = TOGETHER_VALUES) -> Calibrated | None:
    """Train and calibrate on the learning rows; ``None`` if there are none."""
    learns, calibrates = learning_rows(docs, id_column, lang_column)
    labelled = docs.select(
        F.col(lang_column).cast("string").alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        learns.alias("learns"),
        calibrates.alias("calibrates"),
    )
    runs = stage(count_runs(labelled.filter("learns and not calibrates").select("lang", "text")), "runs")
    languages = [r.lang for r in runs.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if not languages:
        return None
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    calibrating = labelled.filter("calibrates").select("lang", "text")
    if runs.select("key").distinct().count() * len(languages) > together:
        return calibrate(spread(runs, languages), calibrating)
    counted = runs.toArrow()
    codes = counted.column("lang").to_numpy(zero_copy_only=False)
    keys = counted.column("key").to_numpy().view(np.uint64)
    n = counted.column("n").to_numpy()
    model = train(languages, {lang: (keys[codes == lang], n[codes == lang]) for lang in languages})
    return calibrate(model, calibrating)


def calibrate(model: Model | Spread, texts: DataFrame) -> Calibrated:
    """Temperature and rejection bounds from texts the model has not counted."""

    def work(model: Model, batch: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
        place = {lang: i for i, lang in enumerate(model.languages)}
        sums, counts, entropy, best = _judged(model, batch.column(1).to_pylist(), table)
        true = np.array([place.get(lang, -1) for lang in batch.column(0).to_pylist()], np.int64)
        used = np.flatnonzero((counts > 0) & (true >= 0))
        sums, true, best = sums[used], true[used], best[used]
        losses = [-np.log(np.maximum(posterior(sums, true, t), 1e-300)) for t in TEMPERATURES]
        columns = [
            pa.array([model.languages[i] for i in best], pa.string()),
            pa.array(counts[used]),
            pa.array(entropy[used, best]),
            pa.array(list(np.stack(losses, axis=1)) if len(used) else [], pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "units", "entropy", "losses"])

    judged = stage(scored(texts, 1, model, work, "lang string, units long, entropy double, losses array<double>"), "judged")
    total = judged.agg(*[F.sum(F.col("losses")[i]).alias(f"t{i}") for i in range(len(TEMPERATURES))]).first()
    temperature = TEMPERATURES[0]
    if total.t0 is not None:
        temperature = TEMPERATURES[min(range(len(TEMPERATURES)), key=lambda i: (total[i], i))]
    centres = judged.groupBy("lang").agg(F.avg("entropy").alias("centre"))
    off = (F.col("entropy") - F.col("centre")) * F.sqrt(F.least("units", F.lit(STEADY_UNITS)))
    bounds = judged.join(F.broadcast(centres), "lang").groupBy("lang", "centre")
    bounds = bounds.agg(F.percentile_approx(off, OWN_SHARE, 10000).alias("bound")).collect()
    centre = np.zeros(len(model.languages))
    bound = np.full(len(model.languages), np.inf)
    for row in bounds:
        at = model.languages.index(row.lang)
        centre[at] = row.centre
        # A few texts say little about the tail, and a text of two learnt languages is no stranger.
        bound[at] = max(SLACK * row.bound, LEAST_SLACK * math.sqrt(STEADY_UNITS))
    return Calibrated(model, temperature, centre, bound)


PREDICTION = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


def identify(docs: DataFrame, fitted: Calibrated | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Predict the language of every text: ``PREDICTION``.  Only the text is read for it."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    if fitted is None:
        blank = [F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")]
        return texts.select("doc_id", *blank, F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    temperature, centre, bound = fitted.temperature, fitted.centre, fitted.bound

    def work(model: Model, batch: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
        names = np.array([*model.languages, UNDETERMINED], object)
        sums, counts, entropy, best = _judged(model, batch.column(1).to_pylist(), table)
        lowest = entropy[np.arange(len(best)), best]
        off = (lowest - centre[best]) * np.sqrt(np.minimum(counts, STEADY_UNITS))
        empty = counts == 0
        rejected = empty | (off > bound[best])
        score = np.where(empty, 0.0, posterior(sums, best, temperature))
        columns = [
            batch.column(0),
            pa.array(names[np.where(empty, len(names) - 1, best)], pa.string()),
            pa.array(score),
            pa.array(lowest, mask=empty),
            pa.array(rejected),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return scored(texts, 1, fitted.model, work, PREDICTION)


def accepted(docs: DataFrame, fitted: Calibrated | None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in a learnt language."""
    if fitted is None:
        return docs.limit(0)
    centre, bound = fitted.centre, fitted.bound
    column = docs.columns.index(text_column)

    def work(model: Model, batch: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
        sums, counts, entropy, best = _judged(model, batch.column(column).to_pylist(), table)
        off = (entropy[np.arange(len(best)), best] - centre[best]) * np.sqrt(np.minimum(counts, STEADY_UNITS))
        return batch.filter(pa.array((counts > 0) & (off <= bound[best])))

    return scored(docs, column, fitted.model, work, docs.schema)
