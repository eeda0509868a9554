"""Language identification by cross-parsing entropy.

Per language, labelled text becomes a suffix automaton. A text is parsed against each of them
into longest matches, and the language whose automaton needs the fewest phrases per character
wins. The transitions of all automata lie in one packed table, whatever the number of characters
and scripts, so that NumPy walks all segments of a slice of texts in lockstep.
"""

from __future__ import annotations

import functools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.text import extended, lowest_hashes

# Labelled characters per language that are learned: the bound of the training sample.
SAMPLE_CHARS = 50_000
# What one text may give of them before all others drawn have given as much.
TEXT_SHARE = 10
# A parse begins anew after so many characters, for all languages alike.
SEGMENT = 1_024
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Rows kept out of learning; a row without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def normal_codes(text: str) -> np.ndarray:
    """Code points of the lower-case text, with every run of non-letters as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, codes, 32)[keep]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions by state of all substrings; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        current = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = current
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return nexts


def packed(states: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each state's transitions begin, and the cells: state << 32 | target, at begin + code.

    States share cells by displacement; a cell belongs to the state that it names. The table takes
    little more than a cell a transition and does not grow with states x characters.
    """
    edges = sum(map(len, states))
    room = edges + edges // 2 + width
    used = bytearray(room + width + 1)
    begin = np.zeros(len(states), np.int32)
    draw = random.Random(3)
    order = sorted((n for n, row in enumerate(states) if len(row) > 1), key=lambda n: -len(states[n]))
    for n in order:
        codes = list(states[n])
        for _ in range(200):
            at = draw.randrange(room)
            if not any(used[at + c] for c in codes):
                break
        else:  # no fit was drawn: cells of its own at the end
            at = len(used)
            used.extend(bytes(width + 1))
        begin[n] = at
        for c in codes:
            used[at + c] = 1
    cells = np.zeros(len(used), np.int64)
    for n in order:
        for c, target in states[n].items():
            cells[begin[n] + c] = n << 32 | target
    single = [(n, c, target) for n, row in enumerate(states) if len(row) == 1 for c, target in row.items()]
    if single:
        n, c, target = (np.array(x, np.int64) for x in zip(*single))
        free = np.flatnonzero(np.frombuffer(used, np.uint8)[width : len(used) - width] == 0)[: len(n)] + width
        if len(free) < len(n):
            more = np.arange(len(n) - len(free)) + len(cells)
            cells = np.concatenate([cells, np.zeros(len(more) + width + 1, np.int64)])
            free = np.concatenate([free, more])
        begin[n] = free - c
        cells[free] = n << 32 | target
    return begin, cells


class Model:
    """Automata of all languages in one table, over all characters of their samples."""

    def __init__(self, samples: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS):
        texts = {lang: np.concatenate([normal_codes(t + " ") for t in parts])[:sample_chars] for lang, parts in sorted(samples.items())}
        self.languages = [lang for lang, codes in texts.items() if len(codes)]
        known = np.unique(np.concatenate([texts[lang] for lang in self.languages] or [np.zeros(0, np.uint32)]))
        self.size = len(known) + 1  # the last code is for all characters that no sample holds
        self.code = np.full(0x110000, len(known), np.int32)
        self.code[known] = np.arange(len(known))
        states, roots = [{}], []  # state 0 is none
        for lang in self.languages:
            base = len(states)
            roots.append(base)
            states += [{c: target + base for c, target in row.items()} for row in suffix_automaton(self.code[texts[lang]].tolist())]
        self.begin, self.cells = packed(states, self.size)
        self.first = np.zeros((len(roots), self.size), np.int32)
        for n, root in enumerate(roots):
            for c, target in states[root].items():
                self.first[n, c] = target

    def phrases(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases per text and language; text i has the codes bounds[i] to bounds[i + 1]."""
        n_texts, n_langs = len(bounds) - 1, len(self.languages)
        pieces = -(-np.diff(bounds) // SEGMENT)
        owner = np.repeat(np.arange(n_texts), pieces)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = bounds[owner] + place * SEGMENT
        length = np.minimum(SEGMENT, bounds[owner + 1] - begin)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        total = np.zeros((n_texts, n_langs), np.int64)
        for start in range(0, len(owner), 8_192):
            part = slice(start, start + 8_192)
            count = self._walk(codes, begin[part], length[part])
            for lang in range(n_langs):
                total[:, lang] += np.bincount(owner[part], count[lang], n_texts).astype(np.int64)
        return total

    def _walk(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        alive = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), "right")
        state = np.zeros((len(self.languages), len(begin)), np.int32)
        count = np.zeros(state.shape, np.int32)
        for step in range(int(length[0])):
            m = alive[step]
            c = codes[begin[:m] + step]
            cell = self.cells[self.begin[state[:, :m]] + c]
            follow = (cell & 0xFFFFFFFF).astype(np.int32)
            missed = (cell >> 32 != state[:, :m]) | (follow == 0)
            count[:, :m] += missed
            np.copyto(follow, self.first[:, c], where=missed)
            state[:, :m] = follow
        return count

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text; score is 1 less best over runner-up entropy."""
        parts = [self.code[normal_codes(text)] if text else np.zeros(0, np.int32) for text in texts]
        bounds = np.cumsum([0] + [len(part) for part in parts])
        if not self.languages or not bounds[-1]:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = self.phrases(np.concatenate(parts), bounds)
        best = total.argmin(1)
        ranked = np.sort(total, 1)
        score = 1 - ranked[:, 0] / ranked[:, 1] if len(self.languages) > 1 else np.ones(len(texts))
        empty = np.diff(bounds) == 0
        names = [UNKNOWN if none else self.languages[i] for i, none in zip(best.tolist(), empty.tolist())]
        return names, np.where(empty, 0.0, score)


def fit(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from ``text`` and ``lang`` of the rows given; rows with a null in either are left out.

    Every language is learned of which some text holds a letter, however rare, long or repeated
    its texts are: distinct texts in order of their hash, until they have ``sample_chars``
    characters, of which one text counts for a tenth at most. What one has beyond that is learned
    only where the language has too few others. At most about ``12 * sample_chars`` characters a
    language reach the driver.
    """
    share = max(1, sample_chars // TEXT_SHARE)
    known = docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).select("text", "lang")
    rows = lowest_hashes(known, "lang", F.least(F.length("text"), F.lit(share)), sample_chars)
    drawn: dict[str, list[str]] = {}
    for row in rows.select("lang", "draw", F.substring("text", 1, sample_chars).alias("text")).orderBy("lang", "draw").collect():
        drawn.setdefault(row["lang"], []).append(row["text"])
    samples = {}
    for lang, texts in drawn.items():
        samples[lang] = [part for at in range(0, sample_chars, share) for t in texts if (part := t[at : at + share])]
    return Model(samples, sample_chars)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of every whole text; only the text is read.

    A null, empty or letterless text is ``und`` with score 0, as is every text when nothing was
    learned. Ties go to the language first in the alphabet. Repeated rows are judged alike, other
    columns are kept as they are (of those two names they are replaced), an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages x sample_chars

    def make(texts):
        names, score = shared.value.predict(texts.to_pylist())
        return [pa.array(names, pa.string()), pa.array(score)]

    return extended(docs, make, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
