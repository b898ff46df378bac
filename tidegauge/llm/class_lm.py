"""Scores of texts by a Brown class-based bigram model.

Training counts every word of all training texts. The most frequent words are put into classes by
exchange clustering: each round, tasks take a word's neighbours by class and find the class that raises
the likelihood of the class bigrams most, for half of the words at a time. Then every further word that
reaches a floor, in one exchange of its own with the classes found, joins the class that its neighbours
speak for; class bigrams are counted anew with all of them. The words that remain, known or not, form one class,
and the end of a text, which also stands before its start, another.

    P(word | word before) = P(class | class before) * P(word | class)

Transitions are class bigram counts, smoothed towards the class frequencies. A word of a learnt class is
emitted by its share of the class; in the class of other words counts are smoothed by one, with one word
kept for the unknown, so the probabilities of all words sum to one. Counts of the most frequent words go
to all tasks, a number that a parameter bounds; the contexts of other words are shuffled by word, and their
counts and classes joined with the texts that hold them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.tokens import runs, text_chunks, words
from tidegauge.session import Scratch

CLUSTERED = 2000  # words that the rounds of exchanges assign; their bigrams number at most its square
CLASSES = 32
ROUNDS = 6
HEAD = 200_000  # words whose counts and classes are sent to all tasks, about 60 bytes each; others are joined
FLOOR = 3  # least count of a word that gets a class
FLUSH_WORDS = 300_000  # different words a task counts before it hands its sums on
SUMS = 2_000_000  # different codes a task sums up before it hands its sums on
MERGE = 250_000  # least number of codes that are merged with the sums at once
WEIGHT = 2.0  # pseudo-counts that draw a transition towards the class frequencies


def _count_words(batches):
    counts: Counter = Counter()

    def flush():
        pairs = list(counts.items())
        counts.clear()
        for at in range(0, len(pairs), 50_000):
            part = pairs[at : at + 50_000]
            yield pa.record_batch(
                {"word": pa.array([w for w, _ in part], pa.binary()), "n": pa.array([n for _, n in part], pa.int64())}
            )

    for (texts,) in text_chunks(batches, "text"):
        for text in texts:
            counts.update(words(text))
            if len(counts) >= FLUSH_WORDS:
                yield from flush()
    yield from flush()


def _ids(tokens: list[bytes], known: dict[bytes, int], other: int) -> np.ndarray:
    return np.fromiter(map(known.get, tokens, repeat(other)), np.int64, len(tokens))


class _Sums:
    """How often each code came. Codes are merged with the sums when they are half as many as those, so that
    the sums are not sorted again for every few texts."""

    def __init__(self):
        self.held, self.new, self.size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0

    def add(self, codes: np.ndarray) -> None:
        self.new.append(np.unique(codes, return_counts=True))
        self.size += len(self.new[-1][0])
        if self.size >= max(MERGE, len(self.held[0]) // 2):
            self._merge()

    def _merge(self) -> None:
        codes, n = (np.concatenate(c) for c in zip(self.held, *self.new))
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        starts = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1)) if len(codes) else np.zeros(0, np.int64)
        self.held = codes[starts], np.add.reduceat(n, starts) if len(codes) else n
        self.new, self.size = [], 0

    def full(self) -> bool:
        return len(self.held[0]) > SUMS

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """The codes and their sums, which begin anew."""
        self._merge()
        held = self.held
        self.held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return held


def _count_bigrams(batches, shared):
    """Counts of neighbouring ids; the vocabulary's size stands for other words, one more for the end."""
    known = shared.value
    other, end = len(known), len(known) + 1
    base = end + 1
    sums = _Sums()
    for (texts,) in text_chunks(batches, "text"):
        parts = []
        for text in texts:
            parts += [_ids(words(text), known, other), np.array([end])]
        line = np.concatenate([np.array([end]), *parts])
        sums.add(line[:-1] * base + line[1:])
        if sums.full():
            yield from _bigram_batches(*sums.take(), base)
    yield from _bigram_batches(*sums.take(), base)


def _bigram_batches(codes, n, base):
    for s in range(0, len(codes), 100_000):
        part = codes[s : s + 100_000]
        yield pa.record_batch({"a": part // base, "b": part % base, "n": n[s : s + 100_000]})


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_class(left: np.ndarray, right: np.ndarray, own: float, now: int, table: np.ndarray, classes: int) -> tuple[int, float]:
    """The class that suits a word best, and what moving it there adds to the log-likelihood."""
    gain = class_gains(left, right, own, now, table, classes)
    best = int(gain.argmax())
    return (best, float(gain[best] - gain[now])) if gain[best] > gain[now] else (now, 0.0)


def class_gains(left: np.ndarray, right: np.ndarray, own: float, now: int, table: np.ndarray, classes: int) -> np.ndarray:
    """For each of the first ``classes`` classes, what a word adds to the log-likelihood in it.

    ``left`` and ``right`` count the word's neighbours by class without itself, ``own`` its repeats, ``now``
    is its class; ``table`` has the bigram counts of all classes.
    """
    rest = table.astype(np.float64).copy()
    rest[now] -= right
    rest[:, now] -= left
    rest[now, now] -= own
    k = np.arange(classes)
    row, col = rest[:classes], rest[:, :classes].T
    gain = (_f(row + right) - _f(row)).sum(1) + (_f(col + left) - _f(col)).sum(1)
    # The corner is in both sums; count it once, with the repeats.
    corner = rest[k, k]
    gain -= _f(corner + right[:classes]) - _f(corner) + _f(corner + left[:classes]) - _f(corner)
    gain += _f(corner + right[:classes] + left[:classes] + own) - _f(corner)
    # The word's neighbours in a class keep their places before and after it, wherever it goes.
    out, in_ = rest.sum(1)[:classes] + left[:classes], rest.sum(0)[:classes] + right[:classes]
    return gain - (_f(out + right.sum() + own) - _f(out) + _f(in_ + left.sum() + own) - _f(in_))


def _exchange(batches, shared, classes: int):
    assigned, table = shared.value
    out = []
    for rows in runs(batches, "word"):
        word = rows.column("word")[0].as_py()
        other, n, before = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("other", "n", "before"))
        same = other == word
        sides = [
            np.bincount(assigned[other[m & ~same]], n[m & ~same], len(table)) for m in (before, ~before)
        ]
        best, gain = best_class(*sides, float(n[same & before].sum()), int(assigned[word]), table, classes)
        out.append((word, best, gain))
    if out:
        word, best, gain = map(list, zip(*out))
        yield pa.record_batch({"word": pa.array(word, pa.int64()), "best": pa.array(best, pa.int64()), "gain": gain})


def _class_table(bigrams: DataFrame, assigned: np.ndarray, size: int) -> np.ndarray:
    """Bigram counts of the classes: at most size * size sums."""
    shared = bigrams.sparkSession.sparkContext.broadcast(assigned)

    def classes(batches):
        for batch in batches:
            a, b = (shared.value[batch.column(c).to_numpy()] for c in "ab")
            sums = np.bincount(a * size + b, batch.column("n").to_numpy(), size * size)
            hit = np.flatnonzero(sums)
            yield pa.record_batch({"a": hit // size, "b": hit % size, "n": sums[hit].astype(np.int64)})

    sums = bigrams.mapInArrow(classes, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((size, size))
    table[sums.column("a").to_numpy(), sums.column("b").to_numpy()] = sums.column("n").to_numpy()
    return table


def exchange_clustering(bigrams: DataFrame, vocabulary: int, classes: int, rounds: int, scratch: Scratch):
    """(class of each id, class bigram counts). Ids from ``vocabulary`` on keep classes of their own.

    ``bigrams`` (a, b, n) is stored; words are numbered by falling frequency and start in turn in each
    class. Odd and even words move in alternate rounds, so that words which belong together do not
    change places for ever.
    """
    size = classes + 2
    assigned = np.concatenate([np.arange(vocabulary) % classes, [classes, classes + 1]])
    sides = bigrams.select(F.col("b").alias("word"), F.col("a").alias("other"), "n", F.lit(True).alias("before"))
    sides = sides.union(bigrams.select(F.col("a"), F.col("b"), "n", F.lit(False))).filter(F.col("word") < vocabulary)
    sides = scratch.table(sides.repartition("word").sortWithinPartitions("word"), "neighbours")
    session = bigrams.sparkSession.sparkContext
    for k in range(rounds):
        shared = session.broadcast((assigned, _class_table(bigrams, assigned, size)))
        half = sides.filter(F.col("word") % 2 == k % 2).repartition("word").sortWithinPartitions("word")
        moves = half.mapInArrow(lambda it, s=shared: _exchange(it, s, classes), "word long, best long, gain double").toArrow()
        assigned = assigned.copy()
        assigned[moves.column("word").to_numpy()] = moves.column("best").to_numpy()
        shared.unpersist()
    scratch.drop("neighbours")
    return assigned, _class_table(bigrams, assigned, size)


def _contexts(batches, shared, rest: bool):
    """What stands around each word that has no class yet: sums for the words sent to tasks, occurrences of others.

    For a word sent, ``id`` and counts of slots: the classes before it, and from ``size`` on those after it.
    For any other, if the ``rest`` is asked for, a row an occurrence with both slots in one number. A word
    beside itself counts as one of the other words, which it is so far.
    """
    known, of, first, size = shared.value
    other, end = len(known), len(known) + 1
    sums = _Sums()

    def batches_of(codes, n):
        for k in range(0, len(codes), 100_000):
            part = codes[k : k + 100_000]
            yield pa.record_batch([pa.array(part // (2 * size), pa.int64()), pa.nulls(len(part), pa.binary()),
                                   pa.array(part % (2 * size), pa.int64()), pa.array(n[k : k + 100_000], pa.int64())], names=_CONTEXT)

    for (texts,) in text_chunks(batches, "text"):
        tokens = [words(text) for text in texts]
        line = np.concatenate([np.array([end]), *(x for own in tokens for x in (_ids(own, known, other), np.array([end])))])
        at = np.flatnonzero((line >= first) & (line < other))
        base = line[at] * (2 * size)
        sums.add(np.concatenate([base + of[line[at - 1]], base + size + of[line[at + 1]]]))
        if sums.full():
            yield from batches_of(*sums.take())
        at = np.flatnonzero(line == other) if rest else np.zeros(0, np.int64)
        if len(at):
            flat = []
            for own in tokens:
                flat += own
                flat.append(b"")  # the ends keep their places
            slots = of[line[at - 1]] * size + of[line[at + 1]]
            yield pa.record_batch([pa.array(np.full(len(at), -1)), pa.array([flat[i - 1] for i in at.tolist()], pa.binary()),
                                   pa.array(slots, pa.int64()), pa.array(np.ones(len(at), np.int64))], names=_CONTEXT)
    yield from batches_of(*sums.take())


_CONTEXT = ["id", "word", "slot", "n"]


def joining_gains(left: np.ndarray, right: np.ndarray, table: np.ndarray, classes: int) -> np.ndarray:
    """:func:`class_gains` of many words without repeats that are in the class of other words, a row each."""
    out = np.zeros((len(left), classes))
    for mine, theirs, counts in ((right, left, table), (left, right, table.T)):
        word, slot = np.nonzero(mine)  # in the order of words
        if len(word):
            n = mine[word, slot][:, None]
            base = counts[:classes].T[slot].astype(np.float64)
            base -= np.where((slot == classes)[:, None], theirs[word, :classes], 0)
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[starts]] += np.add.reduceat(_f(base + n) - _f(base), starts, axis=0)
        total = counts[:classes].sum(1)
        out -= _f(total + mine.sum(1, keepdims=True)) - _f(total)
    corner = np.diag(table)[:classes]
    a, b = left[:, :classes], right[:, :classes]
    return out - _f(corner + a) - _f(corner + b) + _f(corner + a + b) + _f(corner)


JOINED = 5000  # words whose gains are taken together


def _best(slots: np.ndarray, table: np.ndarray, size: int, classes: int) -> np.ndarray:
    return joining_gains(slots[:, :size], slots[:, size:], table, classes).argmax(1)


def _join_classes(batches, shared, size: int, classes: int):
    """The class of each word by its slots; a word's rows follow each other."""
    table, held = shared.value, None

    def flush(rows):
        a, b, n = (rows.column(c).to_numpy() for c in ("id", "slot", "n"))
        word, at = np.unique(a, return_inverse=True)
        for k in range(0, len(word), JOINED):
            mine = (at >= k) & (at < k + JOINED)
            some = min(JOINED, len(word) - k)
            slots = np.bincount((at[mine] - k) * (2 * size) + b[mine], n[mine], some * 2 * size).reshape(some, 2 * size)
            yield pa.record_batch({"word": word[k : k + some], "best": _best(slots, table, size, classes)})

    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        ids = rows.column("id").to_numpy()
        cut = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0  # the last word may go on
        if cut:
            yield from flush(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield from flush(held)


def _join_rest(batches, shared, size: int, classes: int):
    """The same for words that come with the list of their occurrences."""
    table = shared.value
    for batch in batches:
        for k in range(0, batch.num_rows, JOINED):
            rows = batch.slice(k, JOINED)
            lists = rows.column("slots")
            owner = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))
            both = lists.flatten().to_numpy()
            at = np.concatenate([owner * (2 * size) + both // size, owner * (2 * size) + size + both % size])
            slots = np.bincount(at, minlength=rows.num_rows * 2 * size).reshape(rows.num_rows, 2 * size).astype(np.float64)
            best = _best(slots, table, size, classes)
            yield pa.record_batch([rows.column("word"), rows.column("n"), pa.array(best, pa.int64())], names=["word", "n", "class"])


def classes_of_the_rest(
    texts: DataFrame, names: list[bytes], classed: int, first: int, assigned: np.ndarray, table: np.ndarray, classes: int,
    floor: int | None, scratch: Scratch,
) -> tuple[np.ndarray, DataFrame | None]:
    """(class of each name, of any other word and of the end; the classes of words that are no names).

    Names from ``first`` to ``classed`` each join the class that raises the likelihood of the class bigrams
    most, given those before them; they are independent, so tasks take them in any order. So do all
    other words with at least ``floor`` occurrences, if it is given: as a stored table (word, n, class).
    """
    session, size = texts.sparkSession.sparkContext, classes + 2
    known = {w: i for i, w in enumerate(names)}
    of = np.concatenate([assigned[:first], np.full(len(names) - first + 1, classes), [classes + 1]]).astype(np.int64)
    if classed == first and floor is None:
        return of, None
    shared, counts = session.broadcast((known, of, first, size)), session.broadcast(table)
    found = texts.mapInArrow(lambda it: _contexts(it, shared, floor is not None), "id long, word binary, slot long, n long")
    found = scratch.table(found, "contexts")
    slots = found.filter((F.col("id") >= 0) & (F.col("id") < classed)).groupBy("id", "slot").agg(F.sum("n").alias("n"))
    slots = slots.repartition("id").sortWithinPartitions("id")
    moves = slots.mapInArrow(lambda it: _join_classes(it, counts, size, classes), "word long, best long").toArrow()
    of = of.copy()
    of[moves.column("word").to_numpy()] = moves.column("best").to_numpy()
    rest = None
    if floor is not None:
        # Lists are short: no such word is as frequent as the least of the names.
        own = found.filter("id < 0").groupBy("word").agg(F.collect_list("slot").alias("slots"), F.count("*").alias("n"))
        own = own.filter(F.col("n") >= floor).mapInArrow(
            lambda it: _join_rest(it, counts, size, classes), "word binary, n long, class long"
        )
        rest = scratch.table(own, "rest")
    scratch.drop("contexts")
    return of, rest


@dataclass
class Scorer:
    """What a task needs to score texts; all sizes are bounded by parameters."""

    head: dict[bytes, int]  # most frequent words, numbered by falling count
    log_counts: np.ndarray  # log10(count + 1) of those
    classes: np.ndarray  # class of each, and of any other word at the end
    emissions: np.ndarray  # log10 P(word | class) of each, 0 for any other word
    transitions: np.ndarray | None  # log10 P(class | class before)
    end: int  # class of the end
    end_count: int
    base: float  # log10 of the base model's denominator
    totals: np.ndarray  # words of each class, ends in the last one
    others: float  # denominator of words without a learnt class


def _line_type(tail: int, classes: int) -> str:
    """The narrowest integers that hold a line's classes and the numbers of its other words."""
    return next(k for k in ("<i1", "<i2", "<i4") if tail <= -int(np.iinfo(k).min) and classes <= np.iinfo(k).max)


def _lines(batches, shared):
    """Each text as its tokens' classes, and what its words in the head add; other words are numbered from -1 down."""
    s = shared.value
    part, number = TaskContext.get().partitionId() << 33, 0
    other = len(s.head)
    for texts, ids, held in text_chunks(batches, "text", "doc_id", "held_out"):
        out = []
        for text, doc, held_out in zip(texts, ids, held):
            tokens = words(text)
            at = _ids(tokens, s.head, other)
            seen = at[at < other]
            places = np.flatnonzero(at == other)
            others = [tokens[i] for i in places.tolist()]
            tail = Counter(others)
            line = s.classes[at].astype(_line_type(len(tail), s.end))
            numbers = {w: -1 - k for k, w in enumerate(tail)}
            line[places] = [numbers[w] for w in others]
            base = s.log_counts[seen].sum() + np.log10(s.end_count + 1) - (len(tokens) + 1) * s.base
            known = len(seen) + (s.end_count > 0)
            out.append((part + number, doc, held_out, len(tokens) + 1, known, float(base), float(s.emissions[at].sum()),
                        line.tobytes(), list(tail), list(tail.values())))
            number += 1
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
                 pa.list_(pa.binary()), pa.list_(pa.int64())]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=_LINES)


_LINES = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "line", "tail", "times"]


def _classed(batches, shared):
    """The lines with the counts and classes of their other words, which come as lists of place, count and class."""
    s = shared.value
    rest = s.end - 1  # class of words without a learnt one
    logs = np.log10(np.maximum(s.totals, 1))
    for batch in batches:
        rows = batch.to_pydict()
        lines = []
        for k, (line, times) in enumerate(zip(rows["line"], rows["times"])):
            line = np.frombuffer(line, f"<i{len(line) // max(rows['n_tokens'][k] - 1, 1) or 1}").astype(np.int64)
            if times:
                of, n, times = np.full(len(times), rest), np.zeros(len(times)), np.array(times)
                if rows["places"][k]:
                    at = rows["places"][k]
                    n[at] = rows["ns"][k]
                    of[at] = [rest if c is None else c for c in rows["classes"][k]]
                rows["n_known"][k] += int(times[n > 0].sum())
                rows["base"][k] += float((times * np.log10(n + 1)).sum())
                learnt = of != rest
                emitted = np.where(learnt, np.log10(np.maximum(n, 1)) - logs[of], np.log10(n + 1) - np.log10(s.others))
                rows["score"][k] += float((times * emitted).sum())
                line = np.where(line < 0, of[-1 - np.minimum(line, -1)], line)
            lines.append(np.concatenate([line, [s.end]]).astype("<i2").tobytes())
        rows["line"] = lines
        yield pa.record_batch(
            [pa.array(rows[c], t) for c, t in zip(_LINES[1:8], (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()))],
            names=_LINES[1:8],
        )


def _class_bigrams(batches, size: int):
    """Bigram counts of the classes in a task's lines, each of which ends with the end's class."""
    sums = np.zeros(size * size, np.int64)
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("line").to_pylist()), "<i2").astype(np.int64)
        line = np.concatenate([[size - 1], flat])
        sums += np.bincount(line[:-1] * size + line[1:], minlength=size * size)
    hit = np.flatnonzero(sums)
    yield pa.record_batch({"a": hit // size, "b": hit % size, "n": sums[hit]})


def _transit(batches, shared):
    """The scores with those of the transitions."""
    transitions, end = shared.value
    for batch in batches:
        rows = batch.to_pydict()
        for k, line in enumerate(rows["line"]):
            line = np.concatenate([[end], np.frombuffer(line, "<i2")])
            rows["score"][k] += float(transitions[line[:-1], line[1:]].sum())
        yield pa.record_batch([pa.array(rows[c], batch.schema.field(c).type) for c in _SCORED], names=_SCORED)


_SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score"]


def classed_lines(rows: DataFrame, scorer: Scorer, counts: DataFrame, rest: DataFrame | None, scratch: Scratch) -> DataFrame:
    """The texts of ``rows`` (doc_id, text, held_out) as classes, stored, with all of their scores but transitions."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    lines = rows.mapInArrow(
        lambda it: _lines(it, shared),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, line binary, "
        "tail array<binary>, times array<long>",
    )
    lines = scratch.table(lines, "lines")
    tail = lines.select("row", F.posexplode("tail").alias("place", "word")).join(counts, "word")
    if rest is None:
        tail = tail.withColumn("class", F.lit(None).cast("long"))
    else:
        tail = tail.join(rest.select("word", "class"), "word", "left")
    found = tail.groupBy("row").agg(F.collect_list(F.struct("place", "n", "class")).alias("found"))
    found = found.select("row", F.col("found.place").alias("places"), F.col("found.n").alias("ns"), F.col("found.class").alias("classes"))
    classed = lines.drop("tail").join(found, "row", "left").mapInArrow(
        lambda it: _classed(it, shared),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, line binary",
    )
    classed = scratch.table(classed, "classed")
    scratch.drop("lines")
    return classed


def class_transitions(lines: DataFrame, scorer: Scorer) -> np.ndarray:
    """log10 P(class | class before) by the counts of the given lines, smoothed towards the class frequencies."""
    size = scorer.end + 1
    sums = lines.select("line").mapInArrow(lambda it: _class_bigrams(it, size), "a long, b long, n long")
    sums = sums.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()  # at most size * size rows
    table = np.zeros((size, size))
    table[sums.column("a").to_numpy(), sums.column("b").to_numpy()] = sums.column("n").to_numpy()
    share = (scorer.totals + 1) / (scorer.totals + 1).sum()
    return np.log10((table + WEIGHT * share) / (table.sum(1, keepdims=True) + WEIGHT))


def learn(
    texts: DataFrame, scratch: Scratch, clustered: int, classes: int, rounds: int, head: int | None, floor: int, sent: int
):
    """(word counts, Scorer without transitions, number of training tokens, classes of words beyond those sent)."""
    session = texts.sparkSession.sparkContext
    counts = texts.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = scratch.table(counts, "counts")
    n_texts = texts.count()
    n_words, sum_words, n_floor = counts.agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") >= floor)
    ).first()
    tokens, different = sum_words + n_texts, n_words + (n_texts > 0)
    top = counts.orderBy(F.desc("n"), "word").limit(sent if head is None else head).toArrow()  # at most as many rows
    names, n = top.column("word").to_pylist(), top.column("n").to_numpy().astype(np.float64)
    size = min(clustered, len(names))

    known = session.broadcast({w: i for i, w in enumerate(names[:size])})
    bigrams = texts.select("text").mapInArrow(lambda it: _count_bigrams(it, known), "a long, b long, n long")
    bigrams = scratch.table(bigrams.groupBy("a", "b").agg(F.sum("n").alias("n")), "bigrams")
    assigned, table = exchange_clustering(bigrams, size, classes, rounds, scratch)
    # Names are in falling order of their counts, so those that reach the floor come first.
    classed = max(size, int((n >= floor).sum()))
    beyond = floor if head is None and n_floor > classed else None
    of, rest = classes_of_the_rest(texts.select("text"), names, classed, size, assigned, table, classes, beyond, scratch)
    totals = np.bincount(of[:classed], n[:classed], classes + 2)
    n_classed = classed
    if rest is not None:
        for k, words_, sums in rest.groupBy("class").agg(F.count("*"), F.sum("n")).collect():  # a row for each class
            totals[k] += sums
            n_classed += words_
    totals[classes], totals[classes + 1] = sum_words - totals.sum(), n_texts
    others = totals[classes] + (n_words - n_classed) + 1
    emissions = np.concatenate(
        [np.log10(n[:classed] / totals[of[:classed]]) if classed else [], np.log10((n[classed:] + 1) / others), [0.0]]
    )
    scorer = Scorer(
        {w: i for i, w in enumerate(names)}, np.log10(n + 1), of[:-1], emissions, None, classes + 1, n_texts,
        float(np.log10(tokens + different)) if tokens else 0.0, totals, float(others),
    )
    return counts, scorer, tokens, rest


def fit(
    texts: DataFrame, scratch: Scratch, clustered: int, classes: int, rounds: int, head: int | None, floor: int = FLOOR,
    sent: int = HEAD,
):
    """(word counts as a stored table, Scorer, number of training tokens, denominator of other words)."""
    counts, scorer, tokens, rest = learn(texts, scratch, clustered, classes, rounds, head, floor, sent)
    rows = texts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(False).alias("held_out"))
    scorer.transitions = class_transitions(classed_lines(rows, scorer, counts, rest, scratch), scorer)
    return counts, scorer, tokens, scorer.others


def held_out(id_col: str = "doc_id") -> Column:
    """The documents that no count may come from: one in seven by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def lm_scores(
    docs: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, rounds: int = ROUNDS, head: int | None = None,
    floor: int = FLOOR, id_col: str = "doc_id", text_col: str = "text", sent: int = HEAD,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity: one row per row.

    Scores are log10 probabilities of the whole text with its end. ``base_score`` is the unigram model
    smoothed by one; ``perplexity`` is 10 ** (-score / n_tokens). Null and empty texts are scored as an
    end alone. A document with a null id is not held out. Repeated rows are texts of their own. Other
    columns are not looked at; an empty table gives an empty result, and without training texts every
    base probability is 1.

    Every word with ``floor`` occurrences joins a learnt class, unless ``head`` leaves that to so many of the
    most frequent ones. Counts and classes of ``sent`` words go to all tasks, those of others through joins.
    """
    scratch = Scratch(docs.sparkSession, "class-lm")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out")
    )
    counts, scorer, tokens, rest = learn(rows.filter("NOT held_out"), scratch, clustered, classes, rounds, head, floor, sent)
    lines = classed_lines(rows, scorer, counts, rest, scratch)
    shared = docs.sparkSession.sparkContext.broadcast((class_transitions(lines.filter("NOT held_out"), scorer), scorer.end))
    scored = lines.mapInArrow(
        lambda it: _transit(it, shared),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double",
    )
    scored = scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
