"""Class-based bigram language model with Brown classes found by exchange.

First the ``words`` most frequent words move one by one, all others by units of their last three bytes.
Exchange clustering moves units between ``classes`` classes while that raises the likelihood of class bigrams; a quarter
of the units may move at a time, each judged by the class counts before the round, and fewer after a round that did not
help, which is undone. So a round is one Spark job over the unit bigrams, whose number is bounded by the units' square.
Then every other training word that occurs ``least`` times moves too, to the class under which its own
neighbours are most likely, and the class pairs are counted anew over all training texts; were they less likely, the words would stay.
That step has no bound on the vocabulary: neighbours are counted by (word, class), the classes of the ``frequent``
words are sent to all tasks, those of all others are joined. Only words below ``least`` and unseen ones keep the class of their ending.

    P(word | previous) = P(class | previous class) * P(word | class)
    P(d | c)    = (N(c, d) + smooth * (N(d) + 1) / (N + classes)) / (N(c) + smooth)
    P(word | c) = (count + delta) / (N(c) + delta * (known words of c + 1))

so each class keeps the share of one unseen word. A text is its words (A-Z in lower case) and one end,
which is a class of its own and also precedes the first word. Null and empty texts have the end
only. Without training documents the model gives every token probability 1, as the base does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import most_frequent, prepare, text_slices, written
from quern.llm.words import Words, hashed_words

ENDINGS = 512
#: Distinct keys a task gathers before it hands them on.
_HELD = 400_000


@dataclass
class Vocabulary:
    """The most frequent words, ascending by hash; a unit below 0 stands for the word's ending."""

    words: np.ndarray
    count: np.ndarray
    unit: np.ndarray
    units: int

    @property
    def end(self) -> int:
        return self.units + ENDINGS

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes


def endings(words: Words) -> np.ndarray:
    """A bucket for the last three bytes of each word."""
    out = np.zeros(len(words.start), np.uint32)
    for back in range(1, 4):
        at = words.end - back
        byte = words.data[np.maximum(at, 0)].astype(np.uint32)
        byte += np.where((byte >= 65) & (byte <= 90), np.uint32(32), np.uint32(0))
        out = out * np.uint32(0x01000193) + np.where(at >= words.start, byte, np.uint32(0))
    out ^= out >> np.uint32(15)
    return ((out * np.uint32(0x2C1B3C6D)) >> np.uint32(12)).astype(np.int64) % ENDINGS


class Tally:
    """Counts of 64-bit keys; hands all on when it holds many."""

    def __init__(self) -> None:
        self.keys, self.counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(back, np.concatenate(self.counts), len(keys)).astype(np.int64)
        self.__init__()
        return keys, counts


def _word_counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, ending = Tally(), {}

        def handed() -> pa.RecordBatch:
            keys, counts = tally.taken()
            every, first = np.unique(np.concatenate(ending["w"]), return_index=True)
            bucket = np.concatenate(ending["e"])[first]
            ending.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(bucket[np.searchsorted(every, keys)]), pa.array(counts)], ["word", "ending", "n"]
            )

        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                words = hashed_words(batch.column(0).slice(a, b - a))
                keys = words.hashes.view(np.int64)
                tally.add(keys)
                found, first = np.unique(keys, return_index=True)
                ending.setdefault("w", []).append(found)
                ending.setdefault("e", []).append(endings(words)[first])
            if tally.size > 4 * _HELD:
                yield handed()
        if tally.size:
            yield handed()

    made = rows.mapInArrow(run, "word long, ending long, n long")
    return written(made.groupBy("word").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")), "brown-counts")


def _lists(key: np.ndarray, n: np.ndarray, owners: int, width: int) -> list[pa.Array]:
    """What each owner meets and how often, from ascending keys owner * ``width`` + other."""
    ends = pa.array(np.append(0, np.cumsum(np.bincount(key // width, minlength=owners))), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((key % width, pa.int32()), (n, pa.int64()))]


def _summed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Owners and their counts by other, from rows (owner, others, n) in the order of the owners."""
    # The last owner of a batch may go on in the next one.
    owner, counts = np.zeros(0, np.int64), np.zeros((0, width))
    for batch in batches:
        if not len(batch):
            continue
        new, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
        key = np.repeat(at * width, np.diff(batch.column(1).offsets.to_numpy())) + batch.column(1).flatten().to_numpy()
        more = np.bincount(key, batch.column(2).flatten().to_numpy(), len(new) * width).reshape(-1, width)
        if len(owner) and new[0] == owner[-1]:
            more[0] += counts[-1]
        elif len(owner):
            yield owner, counts
        yield new[:-1], more[:-1]
        owner, counts = new[-1:], more[-1:]
    if len(owner):
        yield owner, counts


def _units(words: Words, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, known = vocabulary.find(words.hashes)
    unit = np.where(known, vocabulary.unit[at] if len(vocabulary.unit) else -1, -1)
    return at, known, np.where(unit >= 0, unit, vocabulary.units + endings(words))


def _unit_bigrams(rows: DataFrame, held) -> DataFrame:
    """One row per unit and side: its neighbours there and how often each; never more than the units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        tally, width = Tally(), vocabulary.end + 1

        def handed() -> pa.RecordBatch:
            keys, counts = tally.taken()
            units = np.unique(keys // width)
            keys = np.searchsorted(units, keys // width) * width + keys % width
            return pa.RecordBatch.from_arrays([pa.array(units), *_lists(keys, counts, len(units), width)], ["unit", "other", "n"])

        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                words = hashed_words(batch.column(0).slice(a, b - a))
                unit = _units(words, vocabulary)[2]
                ends = words.first[1:]
                left = np.insert(unit, words.first[:-1], vocabulary.end)
                right = np.insert(unit, ends, vocabulary.end)
                tally.add(left * width + right)
            if tally.size > 4 * _HELD:
                yield handed()
        if tally.size:
            yield handed()

    width = held.value.end + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for units, counts in _summed(batches, width):
            if len(units):
                key = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(units, pa.int32()), *_lists(key, counts.ravel()[key].astype(np.int64), len(units), width)], ["unit", "other", "n"]
                )

    layout = "unit {}, other array<int>, n array<long>"
    dealt = rows.mapInArrow(run, layout.format("long")).repartition("unit").sortWithinPartitions("unit")
    right = written(dealt.mapInArrow(sums, layout.format("int")), "brown-pairs-right")
    pairs = right.select("unit", F.explode(F.arrays_zip("other", "n")).alias("x"))
    left = pairs.groupBy(F.col("x.other").alias("a")).agg(F.collect_list(F.struct("unit", "x.n")).alias("x"))
    left = left.select(F.col("a").alias("unit"), F.lit(1).alias("side"), F.col("x.unit").alias("other"), F.col("x.n").alias("n"))
    return written(right.select("unit", F.lit(0).alias("side"), "other", "n").unionByName(left), "brown-bigrams")


def _by_class(batch: pa.RecordBatch, class_of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """unit, side and the counts of its neighbours by class, one row each."""
    lists = batch.column(2)
    size = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(batch)), size)
    key = row * classes + class_of[lists.flatten().to_numpy()]
    counts = np.bincount(key, batch.column(3).flatten().to_numpy(), len(batch) * classes)
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), counts.reshape(-1, classes)


def class_bigrams(bigrams: DataFrame, class_of: np.ndarray, classes: int) -> np.ndarray:
    """Counts of class pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, classes))
        for batch in batches:
            unit, _, counts = _by_class(batch, class_of, classes)
            np.add.at(total, class_of[unit], counts)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    parts = bigrams.where("side = 0").mapInArrow(run, "counts binary").collect()
    return sum((np.frombuffer(p["counts"]).reshape(classes, classes) for p in parts), np.zeros((classes, classes)))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(right: np.ndarray, left: np.ndarray, old: int, counts: np.ndarray) -> int:
    """The class in which a unit with these neighbour counts helps the likelihood most."""
    base = counts.copy()
    base[old] -= right
    base[:, old] -= left
    np.maximum(base, 0, out=base)
    gain = (_xlogx(base + right) - _xlogx(base)).sum(1) + (_xlogx(base + left[:, None]) - _xlogx(base)).sum(0)
    # A class's own cell gets both sides at once.
    cell = base.diagonal()
    gain += _xlogx(cell + right + left) - _xlogx(cell + right) - _xlogx(cell + left) + _xlogx(cell)
    for sums, own in ((base.sum(1) + left, right.sum()), (base.sum(0) + right, left.sum())):
        gain -= _xlogx(sums + own) - _xlogx(sums)
    gain[-1] = -np.inf  # the end's own class
    # Only a clear gain moves a unit, so that rounding does not.
    return int(gain.argmax()) if gain.max() > gain[old] + 1e-6 * abs(gain[old]) else old


def exchange(bigrams: DataFrame, vocabulary: Vocabulary, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit, and the counts of class pairs under it."""
    class_of = np.arange(vocabulary.end + 1) % (classes - 1)
    class_of[vocabulary.end] = classes - 1
    # Both sides of a unit meet in one task; the table has two rows per unit.
    sided = bigrams.groupBy("unit").agg(
        *[F.first(F.when(F.col("side") == s, F.struct("other", "n")), ignorenulls=True).alias(f"s{s}") for s in (0, 1)]
    )
    flat = written(
        sided.select("unit", *[F.coalesce(F.col(f"s{s}.{c}"), F.array().cast(f"array<{k}>")).alias(f"{c}{s}")
                               for s in (0, 1) for c, k in (("other", "int"), ("n", "bigint"))]),
        "brown-units",
    )
    counts = class_bigrams(bigrams, class_of, classes)
    one_in, told = 4, information(counts)
    for turn in range(rounds):
        now, matrix = class_of, counts

        def move(batches: Iterator[pa.RecordBatch], now=now, matrix=matrix, turn=turn, one_in=one_in) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                unit = batch.column(0).to_numpy().astype(np.int64)
                sides = []
                for s in (0, 1):
                    part = pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(0), batch.column(1 + 2 * s), batch.column(2 + 2 * s)], ["u", "s", "o", "n"]
                    )
                    sides.append(_by_class(part, now, classes)[2])
                turned = ((unit + 7919 * turn) * 2654435761 >> 11) % one_in == 0
                moved = [
                    best_classes(r, left, int(now[u]), matrix) if t and now[u] != classes - 1 else int(now[u])
                    for u, r, left, t in zip(unit.tolist(), *sides, turned.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(moved, pa.int32())], ["unit", "class"])

        found = flat.mapInArrow(move, "unit int, class int").toPandas()  # one row per unit
        after = class_of.copy()
        after[found["unit"].to_numpy()] = found["class"].to_numpy()
        made = class_bigrams(bigrams, after, classes)
        # Units judged apart can spoil each other's moves: then fewer may move at a time.
        if (gained := information(made)) > told:
            class_of, counts, told = after, made, gained
        else:
            one_in *= 2
    return class_of, counts


def information(counts: np.ndarray) -> float:
    """What a class tells about the next one; the likelihood grows with it and with nothing else."""
    return float(_xlogx(counts).sum() - _xlogx(counts.sum(0)).sum() - _xlogx(counts.sum(1)).sum())


def _sides(words: Words, shown: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, left, right) of all neighbours in the texts, the end before and after each."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first) + 1)
    return text, np.insert(shown, words.first[:-1], last), np.insert(shown, words.first[1:], last)


def neighbour_classes(rows: DataFrame, held: Broadcast, class_of: np.ndarray, classes: int, least: int) -> DataFrame:
    """(word, code, n) of the words that have no unit of their own: how often which class follows
    (code is the class) or precedes (code is ``classes`` + the class). Both are lists; a word's rows, one for each time
    a task hands it on, follow each other in one partition.

    Words of which a task knows that they occur less than ``least`` times are left out: those sent to it, and all
    others where the rarest sent word occurs so often at most.
    """
    last = int(class_of[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        enough = vocabulary.count >= least
        others = not len(enough) or vocabulary.count.min() > least
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def handed() -> pa.RecordBatch:
            every = np.unique(np.concatenate([found for found, _, _ in parts]))
            # Each part ascends, so a sort that keeps runs only merges them.
            key = np.concatenate([np.searchsorted(every, found)[k // (2 * classes)] * (2 * classes) + k % (2 * classes) for found, k, _ in parts])
            order = np.argsort(key, kind="stable")
            n, key = np.concatenate([n for _, _, n in parts])[order], key[order]
            parts.clear()
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n, key = np.add.reduceat(n, first), key[first]
            return pa.RecordBatch.from_arrays([pa.array(every), *_lists(key, n, len(every), 2 * classes)], ["word", "code", "n"])

        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                words = hashed_words(batch.column(0).slice(a, b - a))
                at, known, unit = _units(words, vocabulary)
                _, left, right = _sides(words, class_of[unit], last)
                wanted = np.where(known, enough[at], others) if len(enough) else np.full(len(unit), others)
                own = np.flatnonzero((unit >= vocabulary.units) & wanted)
                if not len(own):
                    continue
                place = own + np.searchsorted(words.first, own, side="right") - 1
                found, back = np.unique(words.hashes[own].view(np.int64), return_inverse=True)
                key = np.concatenate([back * 2 * classes + right[place + 1], back * 2 * classes + classes + left[place]])
                key, n = np.unique(key, return_counts=True)
                parts.append((found, key, n))
            if sum(len(x[1]) for x in parts) > 4 * _HELD:
                yield handed()
        if parts:
            yield handed()

    # Words that are frequent have units of their own.
    dealt = rows.mapInArrow(run, "word long, code array<int>, n array<long>").repartition("word")
    return dealt.sortWithinPartitions("word")


def likeliest_classes(sides: DataFrame, step: np.ndarray, in_class: np.ndarray, least: int) -> DataFrame:
    """(word, class): the class under which the word's neighbours are most likely, for words that occur ``least`` times."""
    classes = len(step)
    emit = np.log10(np.maximum(in_class, 1))

    def judged(word: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        after, before = counts[:, :classes], counts[:, classes:]
        n = after.sum(1)
        gain = after @ step.T + before @ step - n[:, None] * emit
        gain[:, -1] = -np.inf  # the end's own class
        keep = n >= least
        return pa.RecordBatch.from_arrays([pa.array(word[keep]), pa.array(gain.argmax(1)[keep], pa.int32())], ["word", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (judged(word, counts) for word, counts in _summed(batches, 2 * classes))

    return sides.mapInArrow(run, "word long, class int")


@dataclass
class Model:
    """``words``: word, ending, n and class (null: that of its ending) of all training words."""

    words: DataFrame
    held: Broadcast
    class_of: np.ndarray
    group: np.ndarray
    pairs: np.ndarray
    in_types: np.ndarray
    tokens: int
    types: int
    ends: int

    @property
    def last(self) -> int:
        return int(self.class_of[-1])


_REST = pa.list_(pa.struct([("place", pa.int32()), ("word", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("own", pa.int32())]))
_REST_TYPE = "array<struct<place: int, word: long, left: int, right: int, own: int>>"


class _Read:
    """Classes of a slice of texts as far as a task knows them; what it does not know goes to ``rest``."""

    def __init__(self, column: pa.Array, vocabulary: Vocabulary, class_of: np.ndarray, group: np.ndarray):
        self.words = words = hashed_words(column)
        self.at, self.known, unit = _units(words, vocabulary)
        self.own = class_of[unit]
        if len(group):
            self.own = np.where(self.known & (group[self.at] >= 0), group[self.at], self.own)
        last = int(class_of[-1])
        self.text, self.left, self.right = _sides(words, np.where(self.known, self.own, -1), last)
        self.whole = (self.left >= 0) & (self.right >= 0)
        #: Place of each word as the right one of two neighbours.
        self.place = np.arange(len(self.own)) + np.repeat(np.arange(len(column)), np.diff(words.first))

    def rest(self) -> pa.Array:
        new = np.flatnonzero(~self.known)
        place = self.place[new]
        fields = [place, self.words.hashes[new].view(np.int64), self.left[place], self.right[place + 1], self.own[new]]
        first = np.concatenate([[0], np.cumsum(~self.known)])[self.words.first]
        made = pa.StructArray.from_arrays([pa.array(f, t.type) for f, t in zip(fields, _REST.value_type, strict=True)], fields=list(_REST.value_type))
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), made)


def _resolved(partly: DataFrame, words: DataFrame) -> DataFrame:
    """row, n, a, b and after of each word in ``rest``: its count, the class before it, its own, the one after (-1: in its own row)."""
    each = partly.select("row", F.inline("rest")).join(words.select("word", "n", "class"), "word", "left")
    each = each.withColumn("b", F.coalesce("class", "own"))
    earlier = F.lag("b").over(Window.partitionBy("row").orderBy("place"))
    return each.select(
        "row", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("left") >= 0, F.col("left")).otherwise(earlier).alias("a"), "b", F.col("right").alias("after")
    )


def class_pairs(rows: DataFrame, words: DataFrame, held: Broadcast, class_of: np.ndarray, group: np.ndarray, classes: int) -> np.ndarray:
    """Counts of class pairs over all texts, every word under its own class."""
    sent = rows.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                seen = _Read(batch.column(0).slice(a, b - a), held.value, class_of, sent.value)
                total += np.bincount(seen.left[seen.whole] * classes + seen.right[seen.whole], minlength=len(total))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + b - a)), seen.rest(), pa.nulls(b - a, pa.binary())], ["row", "rest", "pairs"]
                )
                row += b - a
        yield pa.RecordBatch.from_arrays(
            [pa.array([row]), pa.array([[]], _REST), pa.array([total.tobytes()], pa.binary())], ["row", "rest", "pairs"]
        )

    partly = written(rows.mapInArrow(run, f"row long, rest {_REST_TYPE}, pairs binary").where("pairs IS NOT NULL OR size(rest) > 0"), "brown-pairs")
    out = np.zeros(classes * classes)
    for part in partly.where("pairs IS NOT NULL").select("pairs").collect():  # one matrix a task
        out += np.frombuffer(part["pairs"], np.int64)
    found = _resolved(partly, words)
    both = found.select(F.expr(f"a * {classes} + b").alias("k")).union(found.where("after >= 0").select(F.expr(f"b * {classes} + after")))
    for r in both.groupBy("k").count().collect():
        out[r["k"]] += r["count"]
    return out.reshape(classes, classes)


def _steps(pairs: np.ndarray, smooth: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(class | class before) and how often each class occurs."""
    in_class = pairs.sum(0)
    share = (in_class + 1) / (in_class.sum() + len(pairs))
    return np.log10((pairs + smooth * share) / (pairs.sum(1, keepdims=True) + smooth)), in_class


def train(
    learned: DataFrame, words: int = 4096, frequent: int = 262_144, classes: int = 96, rounds: int = 20, smooth: float = 20.0, least: int = 3
) -> Model:
    """Classes and counts from ``learned`` (text)."""
    spark = prepare(learned.sparkSession)
    counts = _word_counts(learned)
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = learned.count()
    top, top_count = most_frequent(counts, frequent)
    chosen = np.lexsort((top, -top_count))[:words]
    unit = np.full(len(top), -1)
    unit[chosen] = np.arange(len(chosen))
    vocabulary = Vocabulary(top.view(np.uint64), top_count, unit, len(chosen))
    held = spark.sparkContext.broadcast(vocabulary)
    group = np.full(len(top), -1, np.int16)
    if not ends:
        none = np.zeros(vocabulary.end + 1, int)
        empty = counts.withColumn("class", F.lit(None).cast("int"))
        return Model(empty, held, none, group, np.zeros((1, 1)), np.zeros(1), 0, 0, 0)
    class_of, pairs = exchange(_unit_bigrams(learned, held), vocabulary, classes, rounds)
    group[chosen] = class_of[: len(chosen)]
    step, in_class = _steps(pairs, smooth)
    moved = likeliest_classes(neighbour_classes(learned, held, class_of, classes, least), step, in_class, least)
    own = spark.createDataFrame([(int(w), int(c)) for w, c in zip(top[chosen], group[chosen], strict=True)], "word long, class int")
    known = written(counts.join(moved.union(own), "word", "left"), "brown-words")
    bound = F.col("n") >= int(top_count.min()) if len(top) else F.lit(False)
    sent = known.where(bound & F.col("class").isNotNull()).select("word", "class").toPandas()  # ``frequent`` at most
    place, held_here = vocabulary.find(sent["word"].to_numpy().view(np.uint64))
    after = group.copy()
    after[place[held_here]] = sent["class"].to_numpy()[held_here]
    made = class_pairs(learned, known, held, class_of, after, classes)
    if information(made) >= information(pairs):
        group, pairs = after, made
    else:
        known = counts.join(own, "word", "left")
    types = known.groupBy("class", F.when(F.col("class").isNull(), F.col("ending")).alias("ending")).count().collect()
    in_types = np.zeros(classes)
    in_types[class_of[-1]] = 1
    for r in types:
        in_types[r["class"] if r["class"] is not None else class_of[vocabulary.units + r["ending"]]] += r["count"]
    return Model(known, held, class_of, group, pairs, in_types, totals[0] + ends, totals[1] + 1, ends)


def score(
    documents: DataFrame,
    training: str,
    words: int = 4096,
    frequent: int = 262_144,
    classes: int = 96,
    rounds: int = 20,
    smooth: float = 20.0,
    delta: float = 0.5,
    least: int = 3,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of ``documents`` (doc_id, text).

    ``training`` is an SQL condition on doc_id; a row for which it is null is held out. Repeated rows count and are
    scored one by one. ``words`` bounds the units of the first exchange, ``frequent`` the words whose counts and classes
    every task holds; both of all other words are joined.
    """
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return scored(rows, training, train(rows.where(training).select("text"), words, frequent, classes, rounds, smooth, least), smooth, delta)


def scored(rows: DataFrame, training: str, model: Model, smooth: float = 20.0, delta: float = 0.5) -> DataFrame:
    """``rows`` (doc_id, text) under a trained model."""
    spark = rows.sparkSession
    ends, tokens, last, held = model.ends, model.tokens, model.last, model.held
    if ends:
        step, in_class = _steps(model.pairs, smooth)
        value = step - np.log10(in_class + delta * (model.in_types + 1))
    else:
        value, delta = np.zeros((1, 1)), 1.0
    sent = spark.sparkContext.broadcast((model.class_of, model.group, value))
    layout = f"row long, doc_id {{}}, n_tokens long, known long, plus_one double, model double, rest {_REST_TYPE}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, (class_of, group, value) = held.value, sent.value
        row = TaskContext.get().partitionId() << 40
        plus_one, plus_delta = np.log10(vocabulary.count + 1.0), np.log10(vocabulary.count + delta)
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                n = b - a
                seen = _Read(batch.column(1).slice(a, n), vocabulary, class_of, group)
                size = np.diff(seen.words.first)
                text = np.repeat(np.arange(n), size)
                known = seen.known
                base, own = np.zeros(len(known)), np.zeros(len(known))
                if len(vocabulary.words):
                    own[known] = plus_delta[seen.at[known]]
                    base[known] = plus_one[seen.at[known]]
                pairs = np.bincount(seen.text[seen.whole], value[seen.left[seen.whole], seen.right[seen.whole]], n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        batch.column(0).slice(a, n),
                        pa.array(size + 1),
                        pa.array(np.bincount(text, known, n).astype(np.int64) + (ends > 0)),
                        pa.array(np.bincount(text, base, n) + np.log10(ends + 1)),
                        pa.array(np.bincount(text, own, n) + pairs + np.log10(ends + delta)),
                        seen.rest(),
                    ],
                    ["row", "doc_id", "n_tokens", "known", "plus_one", "model", "rest"],
                )
                row += n

    partly = written(rows.mapInArrow(read, layout.format(rows.schema["doc_id"].dataType.simpleString())), "brown-scores")
    values = spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(value)], "a int, b int, v double")
    found = _resolved(partly, model.words)
    # The values have one row per pair of classes.
    found = found.join(F.broadcast(values), ["a", "b"], "left").join(
        F.broadcast(values.toDF("b", "after", "w")), ["b", "after"], "left"
    )
    zero, n = F.lit(0), F.col("n")
    rare = found.groupBy("row").agg(
        F.sum((n > 0).cast("long")).alias("known_rare"),
        F.sum(F.log10(n + 1)).alias("plus_one_rare"),
        F.sum(F.log10(n + F.lit(float(delta))) + F.col("v") + F.coalesce("w", F.lit(0.0))).alias("model_rare"),
    )
    return (
        partly.drop("rest")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            (~F.coalesce(F.expr(training), F.lit(False))).alias("held_out"),
            "n_tokens",
            (F.col("known") + F.coalesce("known_rare", zero)).alias("n_known"),
            F.lit(int(tokens)).cast("long").alias("train_tokens"),
            (
                F.col("plus_one") + F.coalesce("plus_one_rare", zero)
                - F.col("n_tokens") * float(np.log10(tokens + model.types + 1))
            ).alias("base_score"),
            (F.col("model") + F.coalesce("model_rare", zero)).alias("score"),
        )
    )
