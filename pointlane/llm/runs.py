"""Periodic runs of words by grammar compression.

Every text becomes a straight-line grammar over its word ids by Re-Pair: the
most frequent pair of neighbouring symbols becomes a nonterminal, again and
again, until no pair occurs twice. Pairs that don't overlap are replaced in one
round: an occurrence is replaced if its pair is more frequent than the pairs
that overlap it (ties by a random order of pairs), so a round is a few array
operations over all texts of a batch, and a text leaves once nothing repeats.

A run lies in the expansion of the lowest node of the derivation tree that
holds it, and crosses the boundary between that node's two parts. So each
nonterminal long enough is asked once for the runs that cross its boundary, at
its first position; every boundary of the start string, which stands for no
nonterminal, is asked within the whole text. What a nonterminal has is moved to
each position at which the derivation holds it, and intervals of equal period
that overlap by a period are one run; those cut off at the ends of a
nonterminal vanish in the whole one.

A run of period q and at least max(24, 3q) words that crosses a boundary holds
at least max(12, 1.5q) words on one side of it. So five words around the
boundary recur q words further on (or back), as do words up to q/2 on: these
are the candidates, and each is extended word by word within the node.

Defined cases: a null text has no words and no runs, its digests are those of
empty strings; a null doc_id is planted nothing; rows that repeat are worked on
each by itself; a long text is a batch alone (memory in proportion to it); an
empty table gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import slices
from ._words import spelled, word_ids

#: Least words of a run, and least number of periods.
LEAST, TIMES = 24, 3
#: Words around a boundary that recur: all of a run's shorter periods leave four beyond the boundary.
GRAM = 5
#: Bytes of text worked on at once.
BATCH = 2 << 20


def _ends(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _may_repeat(keys: np.ndarray) -> np.ndarray:
    """Which keys may occur more than once, by counts of their hash buckets; never misses one."""
    bits = max(10, int(4 * len(keys) - 1).bit_length())
    bucket = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    bucket = bucket.astype(np.int64)
    return np.bincount(bucket, minlength=1 << bits)[bucket] > 1


class Grammar:
    """The nonterminals of LEAST words or more, with every position; and the boundaries of the start strings."""

    def __init__(self, words: np.ndarray, text: np.ndarray, least: int = LEAST):
        n = len(words)
        sym, own, pos, size = words.astype(np.int64), text, np.arange(n), np.ones(n, np.int64)
        following = int(words.max(initial=-1)) + 1
        limit = following + n + 1
        if (int(own.max(initial=0)) + 1) * limit * limit >= 1 << 63:  # a long text in many: symbols by text, so that pairs alone tell texts apart
            _, sym = np.unique(own * limit + sym, return_inverse=True)
            following = int(sym.max()) + 1
            limit = following + n + 1
            assert limit * limit < 1 << 63
            by_text = 0
        else:
            by_text = limit * limit
        rules, places, lefts, sizes, bounds = [], [], [], [], []
        random = np.random.default_rng(11)
        while len(sym):
            same = own[1:] == own[:-1]
            equal = same & (sym[1:] == sym[:-1])
            # Of a string of equal symbols every other pair counts, from its start.
            at = np.flatnonzero(equal)
            if len(at):
                fresh = np.ones(len(at), bool)
                fresh[1:] = at[1:] != at[:-1] + 1
                start = at[fresh][np.cumsum(fresh) - 1]
                same[at[(at - start) % 2 == 1]] = False
            at = np.flatnonzero(same)
            keys = own[at] * by_text + sym[at] * limit + sym[at + 1]
            some = _may_repeat(keys) if len(keys) else np.zeros(0, bool)
            at = at[some]
            kinds, kind, count = np.unique(keys[some], return_inverse=True, return_counts=True)
            rank = count * (len(kinds) + 1) + random.permutation(len(kinds))
            rank[count < 2] = -1
            order = np.full(len(sym) + 1, -1, np.int64)  # order[i + 1] is of the pair at i
            order[at + 1] = rank[kind]
            here = order[at + 1]
            after = np.append(order, -1)[at + 2]
            won = (here >= 0) & (here > order[at]) & (here > after)
            at, kind = at[won], kind[won]
            kept = np.bincount(kind, minlength=len(kinds)) >= 2
            won = kept[kind]
            at, kind = at[won], kind[won]
            named = np.cumsum(kept) - 1 + following
            following += int(kept.sum())
            total = size[at] + size[at + 1]
            long = total >= least
            rules.append(named[kind[long]])
            places.append(pos[at[long]])
            lefts.append(size[at[long]])
            sizes.append(total[long])
            sym[at], size[at] = named[kind], total
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            # Texts in which nothing was replaced are done; what is left of them is their start string.
            going = np.zeros(int(own[-1]) + 1, bool)
            going[own[at]] = True
            done = stay & ~going[own]
            inner = done[1:] & (own[1:] == own[:-1])
            bounds.append(pos[1:][inner])
            stay &= going[own]
            sym, own, pos, size = sym[stay], own[stay], pos[stay], size[stay]
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        order = np.lexsort((join(places), join(rules)))
        self.rules, self.places, self.lefts, self.sizes = (join(x)[order] for x in (rules, places, lefts, sizes))
        self.bounds = np.sort(join(bounds))


def _matches(words: np.ndarray, at: np.ndarray, shift: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, forwards or backwards, equal those ``shift`` further; ``room`` at most."""
    found, going, width = np.zeros(len(at), np.int64), np.arange(len(at)), 16
    while len(going):
        width = min(width * 2, 1 << 12, max(64, (1 << 20) // len(going)))
        offset = found[going, None] + np.arange(width)
        inside = offset < room[going, None]
        place = np.where(inside, at[going, None] + step * offset, 0)
        good = inside & (words[place] == words[np.where(inside, place + shift[going, None], 0)])
        run = np.where(good.all(1), width, np.argmin(good, 1))
        found[going] += run
        going = going[run == width]
    return found


def crossing(words: np.ndarray, text: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the runs in words[low:high] that cross the boundary before ``at``, for each node."""
    n = len(words)
    none = (np.zeros(0, np.int64),) * 4
    if n < LEAST or not len(at):
        return none
    gram = text[: n - GRAM + 1].astype(np.uint64)
    for i in range(GRAM):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + words[i : n - GRAM + 1 + i].astype(np.uint64)
        gram ^= gram >> np.uint64(29)
    whole = text[GRAM - 1 :] == text[: n - GRAM + 1]
    again = np.flatnonzero(whole)
    again = again[_may_repeat(gram[again])]
    again = again[np.lexsort((again, gram[again]))]
    if not len(again):
        return none
    fresh = np.ones(len(again), bool)
    fresh[1:] = gram[again][1:] != gram[again][:-1]
    heads = np.append(np.flatnonzero(fresh), len(again))
    group = np.cumsum(fresh) - 1
    place = np.full(n + 1, -1, np.int64)
    place[again] = np.arange(len(again))

    nodes, periods, anchors = [], [], []  # anchor: a word that recurs a period later if there is such a run

    def probed(node: np.ndarray, period: np.ndarray, side: int) -> np.ndarray:
        """Candidates whose words up to half a period from the boundary agree too."""
        b = at[node]
        good = np.ones(len(node), bool)
        for part in (2, 4, 3):
            t = period // part
            x = b - 1 + t if side > 0 else b - t
            good &= words[x] == words[x + side * period]
        return good

    for side in (1, -1):
        gram_at = at - 1 if side > 0 else at - GRAM + 1
        fits = (at > low) & (at < high) & ((gram_at + GRAM <= high) if side > 0 else (gram_at >= low))
        node = np.flatnonzero(fits)
        node = node[place[gram_at[node]] >= 0]
        start = place[gram_at[node]]
        k = 0
        while len(node):
            k += 1
            to = start + side * k
            inside = (to >= heads[group[start]]) & (to < heads[group[start] + 1])
            node, start, to = node[inside], start[inside], to[inside]
            period = side * (again[to] - again[start])
            # The further the recurrence, the longer the run must be; beyond the node no later one fits.
            fits = 3 * period <= 2 * ((high[node] - at[node]) if side > 0 else (at[node] - low[node]))
            node, start, period = node[fits], start[fits], period[fits]
            good = probed(node, period, side)
            nodes.append(node[good])
            periods.append(period[good])
            anchors.append(at[nodes[-1]] - (1 if side > 0 else periods[-1]))
            if k == 64 and len(node):  # nodes with many recurrences, each at once
                for x, s in zip(node, start, strict=True):
                    g = group[s]
                    rest = again[s + k + 1 : heads[g + 1]] if side > 0 else again[heads[g] : max(heads[g], s - k)][::-1]
                    rest = side * (rest - again[s])
                    rest = rest[3 * rest <= 2 * ((high[x] - at[x]) if side > 0 else (at[x] - low[x]))]
                    rest = rest[probed(np.full(len(rest), x), rest, side)]
                    nodes.append(np.full(len(rest), x))
                    periods.append(rest)
                    anchors.append(at[x] - (rest * 0 + 1 if side > 0 else rest))
                break
    if not nodes:
        return none
    node, period, anchor = np.concatenate(nodes), np.concatenate(periods), np.concatenate(anchors)
    order = np.lexsort((period, node))
    node, period, anchor = node[order], period[order], anchor[order]
    found = []
    while len(node):  # the least candidate of every node; multiples of a run's period within it are the same run
        first = np.ones(len(node), bool)
        first[1:] = node[1:] != node[:-1]
        x, q, c = node[first], period[first], anchor[first]
        start = c + 1 - _matches(words, c, q, c + 1 - low[x], -1)
        end = c + 1 + _matches(words, c + 1, q, high[x] - q - c - 1, 1) + q
        run = (start <= c) & (start < at[x]) & (end > at[x]) & (end - start >= np.maximum(LEAST, TIMES * q))
        found.append((x[run], start[run], end[run], q[run]))
        to = np.cumsum(first) - 1
        same = run[to] & (period % q[to] == 0) & (anchor >= start[to]) & (anchor + period < end[to])
        keep = ~first & ~same
        node, period, anchor = node[keep], period[keep], anchor[keep]
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else none


def runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, end, period) of every run, by text, start and period; positions count within all words."""
    text = _ends(first)
    grammar = Grammar(words, text)
    fresh = np.ones(len(grammar.rules), bool)
    fresh[1:] = grammar.rules[1:] != grammar.rules[:-1]
    heads = np.append(np.flatnonzero(fresh), len(fresh)).astype(np.int64)
    low = grammar.places[heads[:-1]]
    b = grammar.bounds
    at = np.concatenate([low + grammar.lefts[heads[:-1]], b])
    node, start, end, period = crossing(
        words, text, at, np.concatenate([low, first[text[b]]]), np.concatenate([low + grammar.sizes[heads[:-1]], first[text[b] + 1]])
    )
    # A nonterminal's runs stand at each of its positions.
    rule = node < len(low)
    times = np.ones(len(node), np.int64)
    times[rule] = np.diff(heads)[node[rule]]
    each = np.repeat(np.arange(len(node)), times)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
    shift = np.zeros(len(each), np.int64)
    moved = rule[each]
    shift[moved] = grammar.places[heads[node[each[moved]]] + nth[moved]] - low[node[each[moved]]]
    start, end, period = start[each] + shift, end[each] + shift, period[each]
    # Equal periods that overlap by a period are parts of one run.
    owner = text[start]
    order = np.lexsort((-end, start, period, owner))
    owner, start, end, period = owner[order], start[order], end[order], period[order]
    if not len(start):
        return owner, start, end, period
    family = np.ones(len(start), bool)
    family[1:] = (owner[1:] != owner[:-1]) | (period[1:] != period[:-1])
    lift = (np.cumsum(family) - 1) * (len(words) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    head = family.copy()
    head[1:] |= start[1:] > reach[:-1] - period[1:]
    heads = np.flatnonzero(head)
    owner, start, period, end = owner[heads], start[heads], period[heads], np.maximum.reduceat(end, heads)
    # Of periods over one interval the smallest counts.
    order = np.lexsort((period, end, start, owner))
    owner, start, end, period = owner[order], start[order], end[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    owner, start, end, period = owner[least], start[least], end[least], period[least]
    order = np.lexsort((period, start, owner))
    return owner[order], start[order], end[order], period[order]


def planted(n: int, h: int | None) -> tuple[int, int] | None:
    """(first word, period) of the repetition that the query plants in a text of ``n`` words, if any; h: crc32 of the id."""
    if h is None or h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


_RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ]
)


def _detected(batch: pa.RecordBatch, plant: bool) -> pa.RecordBatch:
    """Rows of _RESULT for a batch of (doc_id, text)."""
    ids, vocabulary, first = word_ids(batch.column(1))
    source = np.arange(len(ids))
    for i, key in enumerate(batch.column(0).to_pylist()) if plant else ():
        low, n = int(first[i]), int(first[i + 1] - first[i])
        if key is not None and (p := planted(n, zlib.crc32(str(key).encode()))):
            a = low + p[0]
            source[a : low + n] = a + np.arange(low + n - a) % p[1]
    ids = ids[source]
    owner, start, end, period = runs(ids, first)
    keep = np.ones(len(ids), bool)
    for s, e, q in zip(start, end, period, strict=True):
        keep[s + q : e] = False
    each = pa.StructArray.from_arrays([pa.array(start - first[owner]), pa.array(end - start), pa.array(period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)), each)
    return pa.RecordBatch.from_arrays([batch.column(0), lists, spelled(ids, vocabulary, first, keep).cast(pa.string())], _RESULT.names)


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """doc_id, the runs of every text by start and period, and the text without their periods after the first, words joined by one space.

    ``plant`` makes texts periodic as ``planted`` says, before they are read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1), BATCH):
                yield _detected(batch.slice(low, high - low), plant)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, _RESULT)


def summary(found: DataFrame) -> DataFrame:
    """Of what ``detect`` returns: the number of runs, the run of the greatest exponent, and digests."""
    # By start, then period: only a greater exponent takes over.
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda a, x: F.when(a.isNull() | (x["length"] * a["period"] > a["length"] * x["period"]), x).otherwise(a))
    lines = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
