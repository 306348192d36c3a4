"""Periodic runs of words, from Lyndon roots that the first phase of a suffix sorter yields.

1. A run that is kept holds each of its words at least `times` times. Words that are
   rarer inside their stretch of text part it, again and again until nothing changes;
   no run and no extension of one crosses such a word, so the rest is exact.
2. Every stretch left goes through Baier's grouping (`lyndon_lengths`): suffixes start
   in a group per first word; groups are taken from the highest down, and each suffix
   of a group extends the suffix its pointer names by the group's context. At the end
   the context of a group is the longest Lyndon word at the start of its suffixes. The
   grouping runs under the order of the words and under the reversed order.
3. The root of every run is such a word under one of the two orders. Roots that stand
   `times - 1` times in a row are extended to both sides by the longest common
   extension with the text one root on (`common_length`), which gives the run.

The words are compared themselves, by a number per distinct word, not by a hash.
All work is inside a document; the rows stay where they are and nothing is shuffled.

Defined cases: null, empty and blank texts have no words, no runs and an empty
collapsed text; rows with a null or a repeated id are judged each for itself; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import BLANKS, WORD

TIMES = 4  # a run is at least so many periods long
LEAST = 6  # and at least so many words

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
RUNS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


class WordNumbers(dict):
    """A number for each distinct word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def stretches(words: np.ndarray, owner: np.ndarray, times: int, least: int) -> list[tuple[int, int]]:
    """(first, end) of the stretches in which every word stands `times` times or more.

    `owner` numbers the document of each word; a stretch never leaves it.
    """
    at, stretch = np.arange(len(words)), owner
    while len(at):
        _, group, counts = np.unique(stretch * (words.max() + 1) + words[at], return_inverse=True, return_counts=True)
        stay = counts[group] >= times
        kept, old = at[stay], stretch[stay]
        if not len(kept):
            return []
        begins = np.concatenate([[True], (np.diff(kept) > 1) | (np.diff(old) != 0)])
        fresh = np.cumsum(begins) - 1
        long = np.bincount(fresh)[fresh] >= least
        if stay.all() and long.all():
            first = kept[begins]
            return list(zip(first.tolist(), (first + np.bincount(fresh)).tolist(), strict=True))
        at, stretch = kept[long], fresh[long]
    return []


def lyndon_lengths(text: list[int], reverse: bool = False) -> list[int]:
    """Length of the longest Lyndon word at every place, by Baier's grouping.

    `reverse` turns the order of the letters; the end of the text is below all of
    them in either case. Place 0 of the working arrays stands before the text.
    """
    n = len(text)
    members: list[list[int]] = []
    group = [0] * (n + 1)
    letters: dict[int, list[int]] = {}
    for i, letter in enumerate(text, 1):
        letters.setdefault(letter, []).append(i)
    for g, letter in enumerate(sorted(letters, reverse=reverse)):
        members.append(letters[letter])
        for i in letters[letter]:
            group[i] = g
    size = [len(m) for m in members]
    length = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    pointer, done = [0] * (n + 1), bytearray(n + 1)
    g = len(members) - 1
    while g >= 0:
        own, context = members[g], length[g]
        if len(own) != size[g]:
            own = [i for i in own if group[i] == g]
        pointed: dict[int, int] = {}
        for i in own:
            j = i - 1
            while done[j]:
                j = pointer[j]
            pointer[i] = j
            done[i] = 1
            if j:
                pointed[j] = pointed.get(j, 0) + 1
        # Those that more of this group follow stand higher; each part of a group moves right above it.
        parts: dict[tuple[int, int], list[int]] = {}
        for j, often in pointed.items():
            parts.setdefault((often, group[j]), []).append(j)
        for often, old in sorted(parts, reverse=True) if len(parts) > 1 else parts:
            part = parts[often, old]
            if len(part) == size[old]:
                length[old] += often * context
                continue
            new, over = len(members), above[old]
            members.append(part)
            size.append(len(part))
            size[old] -= len(part)
            length.append(length[old] + often * context)
            below.append(old)
            above.append(over)
            above[old] = below[over] = new
            for j in part:
                group[j] = new
        g = below[g]
    return [length[g] for g in group[1:]]


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading items of two arrays agree; blocks double, so a short answer is cheap."""
    n, at, block = min(len(a), len(b)), 0, 16
    while at < n:
        same = a[at:min(at + block, n)] == b[at:min(at + block, n)]
        if not same.all():
            return at + int(same.argmin())
        at, block = at + block, 2 * block
    return n


def runs_of(text: np.ndarray, times: int = TIMES, least: int = LEAST) -> set[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of at least `times` periods and `least` items."""
    n, found, letters = len(text), set(), text.tolist()
    for reverse in (False, True):
        period = np.array(lyndon_lengths(letters, reverse), dtype=np.int64)
        first = np.flatnonzero(np.arange(n) + (times - 1) * period <= n)
        for k in range(1, times - 1):
            first = first[period[first + k * period[first]] == period[first]]
        ends: dict[int, int] = {}
        for i, q in zip(first.tolist(), period[first].tolist(), strict=True):
            if i + q <= ends.get(q, 0):
                continue  # a further root of the run found last
            end = i + q + common_length(text[i:], text[i + q:])
            start = i - (common_length(text[i - 1::-1], text[i + q - 1::-1]) if i else 0)
            ends[q] = end
            if end - start >= max(least, times * q):
                found.add((start, end - start, q))
    return found


def periodic_runs(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, runs by start and period, and the collapsed text.

    The collapsed text leaves out every word that some run holds after its first
    period; the words kept are joined by one space.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                numbers = WordNumbers()
                split = [text.encode().split() if text else [] for text in rows.column("text").to_pylist()]
                counts = [len(s) for s in split]
                codes = np.fromiter((numbers[w] for s in split for w in s), dtype=np.int64, count=sum(counts))
                starts = np.cumsum([0, *counts])
                runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
                for first, end in stretches(codes, np.repeat(np.arange(len(split)), counts), times, least):
                    own = int(np.searchsorted(starts, first, side="right")) - 1
                    runs[own] += [(first - int(starts[own]) + s, n, q) for s, n, q in runs_of(codes[first:end], times, least)]
                texts = []
                for words, found in zip(split, runs, strict=True):
                    if found:
                        found.sort(key=lambda r: (r[0], r[2]))
                        change = np.zeros(len(words) + 1, dtype=np.int64)
                        for start, length, q in found:
                            change[start + q] += 1
                            change[start + length] -= 1
                        gone = change.cumsum() > 0
                        words = [w for w, g in zip(words, gone.tolist(), strict=False) if not g]
                    texts.append(b" ".join(words).decode())
                dicts = [[{"start": s, "length": n, "period": q} for s, n, q in found] for found in runs]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(dicts, pa.list_(RUN)), pa.array(texts, pa.string())],
                    schema=RUNS_ARROW,
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(each, RUNS)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period; of equals the first by start and period; null without runs."""
    higher = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)), lambda best, run: F.when(higher(best, run), run).otherwise(best))


def with_planted_periods(docs: DataFrame, every: int = 10) -> DataFrame:
    """(doc_id, text), the words of some documents made periodic from a place on.

    Of documents whose h = crc32(doc_id) is divisible by `every`, with g = h // every and n
    words, every word i from a = g % n on becomes word a + (i - a) % p of the text, where
    p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / every)
    words = F.array_remove(F.split(F.col("text"), BLANKS), "")

    def planted(split: Column) -> Column:
        n = F.size(split)
        a = F.pmod(g, n.cast("bigint")).cast("int")
        p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        root = F.slice(split, a + 1, p)
        repeats = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(root, repeats)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(split, F.lit(1), a), tail), " ")

    chosen = (h % every == 0) & F.col("text").rlike(WORD)
    return docs.select("doc_id", F.when(chosen, planted(words)).otherwise(F.col("text")).alias("text"))
