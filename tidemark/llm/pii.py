"""Personal data: fixed patterns, and a character-level BiLSTM-CRF for what they miss.

The network reads characters in both directions; a CRF over its outputs decodes the best tag
sequence of a window. It is trained in NumPy on spans that the patterns label in a bounded
sample, as they stand and in other ways of writing them. Texts are read in overlapping windows;
each character takes the tag of the window in which it stands furthest from an edge, and runs
of tags over the whole text become spans.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.text import extended, lowest_hashes

KINDS = ("email", "ip", "card", "phone")
# Texts of the training sample, how many of them may lack a span, and windows made of them.
SAMPLE_TEXTS, QUIET_TEXTS, SAMPLE_WINDOWS = 2_000, 800, 3_000
# A corpus whose sample of matching texts holds fewer spans has none to learn from.
LEAST_SPANS = 20
# Signs of a span: every text with one has a match of these, and few others have.
SIGNS = (
    "[A-Za-z0-9._%+-]@[A-Za-z0-9-]+[.][A-Za-z0-9-]|[0-9][.][0-9]+[.][0-9]+[.][0-9]"
    "|[0-9]([\\x20-]?[0-9]){15}|[+][0-9][\\x20().0-9-]{6,}[0-9]"
)
HIDDEN = 8
WINDOW, OVERLAP = 256, 64
TRAIN_WINDOW = 80
BATCH = 1_024
OTHER_LETTER, OTHER, PAD = 128, 129, 130

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match begins where a run of digits does: from within a run nothing else would follow.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (kind number, start, end) of the fixed patterns, by kind and start."""
    spans = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            spans.append((0, start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(map(_byte, m.group().split("."))):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


@functools.cache
def _classes() -> np.ndarray:
    table = np.array([OTHER_LETTER if chr(i).isalpha() else OTHER for i in range(0x110000)], np.uint8)
    table[:128] = np.arange(128)
    table[65:91] += 32
    return table


def codes_of(text: str) -> np.ndarray:
    return _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


@dataclass
class Network:
    """Input weights per character (with bias), recurrent weights, of both directions; output; transitions."""

    inputs: list[np.ndarray]  # (4H, characters) each
    loops: list[np.ndarray]  # (4H, H) each
    out: np.ndarray  # (tags, 2H)
    bias: np.ndarray
    moves: np.ndarray  # (tags, tags): from, to

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.loops, self.out, self.bias, self.moves]


def new_network(seed: int = 5) -> Network:
    draw = np.random.default_rng(seed)
    k = len(KINDS) + 1

    def some(*shape, scale):
        return (draw.normal(size=shape) * scale).astype(np.float32)

    inputs = [some(4 * HIDDEN, PAD + 1, scale=0.3) for _ in range(2)]
    for table in inputs:
        table[:HIDDEN] -= 0.5
        table[HIDDEN : 2 * HIDDEN] += 1.0
    return Network(
        inputs, [some(4 * HIDDEN, HIDDEN, scale=0.3) for _ in range(2)], some(k, 2 * HIDDEN, scale=0.3),
        np.array([1.0] + [0.0] * (k - 1), np.float32), np.eye(k, dtype=np.float32),
    )


def _run(table, loop, codes, keep: list | None):
    """One direction over codes (time, batch): hidden states (time, H, batch). Gates are piecewise linear."""
    steps, n = codes.shape
    h = np.zeros((HIDDEN, n), np.float32)
    c = np.zeros((HIDDEN, n), np.float32)
    states = np.empty((steps, HIDDEN, n), np.float32)
    for t in range(steps):
        z = loop @ h
        z += table[:, codes[t]]
        gates = z[: 3 * HIDDEN]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0, 1, out=gates)
        raw = z[3 * HIDDEN :]
        np.clip(raw, -1, 1, out=raw)
        if keep is not None:
            keep.append((z.copy(), c.copy(), h.copy()))
        c = gates[HIDDEN : 2 * HIDDEN] * c
        c += gates[:HIDDEN] * raw
        h = gates[2 * HIDDEN :] * np.clip(c, -1, 1)
        states[t] = h
    return states


def emissions(net: Network, codes: np.ndarray, keep=None) -> tuple[np.ndarray, np.ndarray]:
    """Tag scores (time, tags, batch) and the states of both directions (time, 2H, batch)."""
    ahead = _run(net.inputs[0], net.loops[0], codes, None if keep is None else keep[0])
    back = _run(net.inputs[1], net.loops[1], codes[::-1], None if keep is None else keep[1])[::-1]
    states = np.concatenate([ahead, back], 1)
    return np.matmul(net.out, states) + net.bias[:, None], states


def decode(net: Network, scores: np.ndarray) -> np.ndarray:
    """Best tags (time, batch) by Viterbi."""
    steps, k, n = scores.shape
    best = scores[0]
    came = np.zeros((steps, k, n), np.uint8)
    for t in range(1, steps):
        total = best[0] + net.moves[0][:, None]
        for source in range(1, k):
            other = best[source] + net.moves[source][:, None]
            better = other > total
            came[t][better] = source
            np.maximum(total, other, out=total)
        best = total + scores[t]
    tags = np.empty((steps, n), np.uint8)
    tags[-1] = best.argmax(0)
    every = np.arange(n)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = came[t, tags[t], every]
    return tags


def _log_sum(x, axis):
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def loss_and_gradients(net: Network, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the CRF and its gradients, by parameter."""
    keep = ([], [])
    scores, states = emissions(net, codes, keep)
    steps, k, n = scores.shape
    ahead = [scores[0]]
    for t in range(1, steps):
        ahead.append(_log_sum(ahead[-1][:, None] + net.moves[:, :, None], 0) + scores[t])
    back = [np.zeros((k, n), np.float32)]
    for t in range(steps - 1, 0, -1):
        back.append(_log_sum(net.moves[:, :, None] + (scores[t] + back[-1])[None], 1))
    back.reverse()
    total = _log_sum(ahead[-1], 0)
    every = np.arange(n)
    gold = scores[0][tags[0], every].copy()
    d_scores = np.empty_like(scores)
    d_moves = np.zeros_like(net.moves)
    for t in range(steps):
        d_scores[t] = np.exp(ahead[t] + back[t] - total)
        d_scores[t][tags[t], every] -= 1
        if t:
            gold += scores[t][tags[t], every] + net.moves[tags[t - 1], tags[t]]
            both = np.exp(ahead[t - 1][:, None] + net.moves[:, :, None] + (scores[t] + back[t])[None] - total)
            d_moves += both.sum(2)
            np.subtract.at(d_moves, (tags[t - 1], tags[t]), 1)
    d_scores /= n
    d_out = np.einsum("tkn,thn->kh", d_scores, states)
    d_bias = d_scores.sum((0, 2))
    d_states = np.matmul(net.out.T, d_scores)
    d_inputs, d_loops = [], []
    for side in range(2):
        order = range(steps - 1, -1, -1) if side == 0 else range(steps)
        table, loop = np.zeros_like(net.inputs[side]), np.zeros_like(net.loops[side])
        d_h = np.zeros((HIDDEN, n), np.float32)
        d_c = np.zeros((HIDDEN, n), np.float32)
        for t in order:
            z, c_before, h_before = keep[side][t if side == 0 else steps - 1 - t]
            i, f, o, g = (z[j * HIDDEN : (j + 1) * HIDDEN] for j in range(4))
            c = f * c_before + i * g
            bent = np.clip(c, -1, 1)
            d_h = d_h + d_states[t, side * HIDDEN : (side + 1) * HIDDEN]
            d_c = d_c + d_h * o * (np.abs(c) < 1)
            d_z = np.concatenate([
                d_c * g * 0.25 * ((i > 0) & (i < 1)), d_c * c_before * 0.25 * ((f > 0) & (f < 1)),
                d_h * bent * 0.25 * ((o > 0) & (o < 1)), d_c * i * (np.abs(g) < 1),
            ])
            loop += d_z @ h_before.T
            hot = np.zeros((n, PAD + 1), np.float32)
            hot[every, codes[t]] = 1
            table += d_z @ hot
            d_h = net.loops[side].T @ d_z
            d_c = d_c * f
        d_inputs.append(table)
        d_loops.append(loop)
    return float((total - gold).mean()), [*d_inputs, *d_loops, d_out, d_bias, d_moves / n]


def train(windows: list[tuple[np.ndarray, np.ndarray]], steps: int = 360, batch: int = 96, seed: int = 5) -> Network:
    """A network by Adam on windows of codes and tags of TRAIN_WINDOW characters."""
    net, draw = new_network(seed), np.random.default_rng(seed)
    codes = np.stack([c for c, _ in windows], 1)
    tags = np.stack([t for _, t in windows], 1)
    m = [np.zeros_like(p) for p in net.parameters()]
    v = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        pick = draw.integers(0, codes.shape[1], batch)
        _, gradients = loss_and_gradients(net, codes[:, pick], tags[:, pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.02 * min(1.0, 2 * (steps - step + 1) / steps) * min(1.0, 5.0 / (norm + 1e-9))
        for p, g, a, b in zip(net.parameters(), gradients, m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def _variants(kind: int, span: str, draw) -> str:
    """The span as it is or written in another way."""
    way = draw.integers(0, 3)
    if kind == 2:
        digits = re.sub(r"[^0-9]", "", span)
        mark = "./_"[draw.integers(0, 3)]
        return span if way == 0 else mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == 3 and way:
        rest = re.sub(r"^\+[0-9]+[\x20.-]*", "", span)
        return rest if way == 1 and sum(c.isdigit() for c in rest) >= 8 else span.replace("-", "/").replace("+", "00")
    return span


def training_windows(texts: list[str], seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around labelled spans, some rewritten, and as many windows without any, of at most SAMPLE_WINDOWS."""
    draw = np.random.default_rng(seed)
    windows, quiet, spans_seen = [], [], 0
    for text in texts:
        spans = sorted(base_spans(text), key=lambda s: s[1])
        spans_seen += len(spans)
        for kind, start, end in [*spans, *(s for s in spans if s[0] >= 2)]:  # kinds with variants twice
            written = _variants(kind, text[start:end], draw)
            room = TRAIN_WINDOW - len(written)
            if room < 2:
                continue
            lead = int(draw.integers(0, room))
            before, after = text[max(0, start - lead) : start], text[end : end + room - lead]
            near = codes_of(before + written + after)[:TRAIN_WINDOW]
            tags = np.zeros(TRAIN_WINDOW, np.int64)
            tags[len(before) : len(before) + len(written)] = kind + 1
            for other, a, b in spans:  # neighbours that the window also shows
                if b <= start:
                    a, b = a - start + len(before), b - start + len(before)
                elif a >= end:
                    a, b = a - end + len(before) + len(written), b - end + len(before) + len(written)
                else:
                    continue
                tags[max(a, 0) : max(b, 0)] = other + 1
            windows.append((np.pad(near, (0, TRAIN_WINDOW - len(near)), constant_values=PAD), tags))
        for _ in range(2):
            at = int(draw.integers(0, max(1, len(text) - TRAIN_WINDOW)))
            if not any(s[1] < at + TRAIN_WINDOW and s[2] > at for s in spans):
                near = codes_of(text[at : at + TRAIN_WINDOW])
                quiet.append((np.pad(near, (0, TRAIN_WINDOW - len(near)), constant_values=PAD), np.zeros(TRAIN_WINDOW, np.int64)))
    if spans_seen < LEAST_SPANS:
        return []
    for found in (windows, quiet):
        draw.shuffle(found)
    windows = windows[: SAMPLE_WINDOWS // 2]
    return windows + quiet[: len(windows)]


def fit(docs: DataFrame) -> Network | None:
    """Train on a hash-drawn sample of about SAMPLE_TEXTS distinct texts.

    All but QUIET_TEXTS of them are drawn from the texts that show signs of a span, however rare
    these are; the quiet ones from others with a digit or ``@``. None if the sample holds fewer
    than LEAST_SPANS spans, as only a corpus does that has hardly any.
    """
    marked = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.col("text").rlike(SIGNS).alias("signs"))
    # A text weighs as much as the other group's number of texts: both groups reach the product.
    weight = F.when(F.col("signs"), QUIET_TEXTS).otherwise(SAMPLE_TEXTS - QUIET_TEXTS)
    drawn = lowest_hashes(marked, "signs", weight, QUIET_TEXTS * (SAMPLE_TEXTS - QUIET_TEXTS))
    windows = training_windows([row["text"] for row in drawn.orderBy("signs", "draw").select("text").collect()])
    return train(windows) if windows else None


def tag_texts(net: Network, texts: list[str]) -> list[np.ndarray]:
    """Tags of every character, by overlapping windows."""
    codes = [codes_of(text) for text in texts]
    lengths = np.array([len(c) for c in codes])
    core = WINDOW - OVERLAP
    counts = np.where(lengths > 0, np.maximum(1, -(-(lengths - OVERLAP) // core)), 0)
    text = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    bounds = np.cumsum(lengths) - lengths
    every = np.concatenate([*codes, np.array([PAD], np.uint8)]) if codes else np.array([PAD], np.uint8)
    out = np.zeros(len(every), np.uint8)
    for start in range(0, len(text), BATCH):
        own, nth = text[start : start + BATCH], place[start : start + BATCH]
        at = nth * core + np.arange(WINDOW)[:, None]
        inside = at < lengths[own]
        index = np.where(inside, bounds[own] + at, len(every) - 1)
        tags = decode(net, emissions(net, every[index])[0])
        first = np.where(nth > 0, OVERLAP // 2, 0)
        last = np.where(nth < counts[own] - 1, WINDOW - OVERLAP // 2, WINDOW)
        step = np.arange(WINDOW)[:, None]
        keep = inside & (step >= first) & (step < last)
        out[index[keep]] = tags[keep]
    return [out[b : b + n] for b, n in zip(bounds.tolist(), lengths.tolist())]


def _valid(kind: int, span: str) -> bool:
    """What a found span must hold to be added: as strict as the patterns on content, not on form."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 0:
        return re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]+", span) is not None
    if kind == 1:
        parts = re.findall(r"[0-9]+", span)
        return len(parts) == 4 and all(map(_byte, parts))
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and len(re.findall(r"[^0-9]+", span.strip("()"))) >= 2 and re.search(r"[^\W0-9]|\n", span) is None


def added_spans(text: str, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of tags that are valid and touch no span of the patterns."""
    marked = np.flatnonzero(tags)
    if not len(marked):
        return []
    edges = np.flatnonzero(np.diff(np.r_[0, tags > 0, 0].astype(np.int8)))
    spans = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        # A run of several kinds is of the kind it has most of that its content allows.
        votes = np.bincount(tags[start:end], minlength=len(KINDS) + 1)[1:]
        while start < end and not (text[start].isalnum() or text[start] in "(+"):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        # A run that breaks off within a number is no whole one.
        if start == end or (text[start - 1 : start].isdigit() and text[start].isdigit()) or (
            text[end : end + 1].isdigit() and text[end - 1].isdigit()
        ) or any(a < end and b > start for _, a, b in base):
            continue
        kinds = [k for k in np.argsort(-votes, kind="stable").tolist() if votes[k] and _valid(k, text[start:end])]
        spans += [(kinds[0], start, end)] if kinds else []
    return spans


def find_spans(docs: DataFrame, net: Network | None, column: str = "spans") -> DataFrame:
    """``docs`` with all spans: ``kind, start, end`` (code points) and ``base``, by kind and start.

    Null and empty texts have none. With no network only the patterns are applied. Repeated rows
    get the same spans; other columns are kept; one named like ``column`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def make(column_of_texts):
        own = shared.value
        texts = column_of_texts.to_pylist()
        tags = tag_texts(own, texts) if own is not None else [np.zeros(0, np.uint8)] * len(texts)
        rows = []
        for text, tag in zip(texts, tags):
            base = base_spans(text)
            both = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, tag, base)]
            rows.append([{"kind": KINDS[k], "start": a, "end": b, "base": c} for k, a, b, c in sorted(both)])
        return [pa.array(rows, kinds)]

    span = T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
    ]))
    return extended(docs, make, [T.StructField(column, span)])


def redact(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with each span's text replaced by its kind in brackets, where spans overlap by the first."""
    own = "pii_spans"
    while own in {name.lower() for name in docs.columns}:
        own += "_"
    found = find_spans(docs, net, own)
    pieces = (
        f"aggregate(array_sort({own}, (a, b) -> a.start - b.start), named_struct('text', '', 'at', 0), (s, p) -> "
        "CASE WHEN p.start < s.at THEN s ELSE named_struct('text', s.text || substr(text, s.at + 1, p.start - s.at) || '[' || p.kind || ']', 'at', p.end) END, "
        "s -> s.text || substr(text, s.at + 1))"
    )
    fresh = F.when(F.size(own) == 0, F.col("text")).otherwise(F.expr(pieces))
    return found.withColumn("text", F.when(F.col(own).isNotNull(), fresh)).drop(own)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_spans(docs, fit(docs))
    listed = "array_join(transform(filter(spans, s -> {}), s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"bigint(size(filter(spans, s -> s.kind = '{kind}' AND s.base)))").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.expr(listed.format("s.base")), 256).alias("base_sha256"), F.expr(listed.format("true")).alias("spans"),
    )
