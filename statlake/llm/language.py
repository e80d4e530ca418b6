"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads segments of a text in both directions and gives every byte a probability for each
language; a document's probabilities are the mean over its bytes. It is trained in numpy by
backpropagation through time on a bounded sample of segments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import blob, held_out, id_column, map_rows

HIDDEN, SEGMENT, BATCH = 8, 96, 1024
#: Learning rows for each language, about; least segments of a row, and bytes of it for each one.
SAMPLE_ROWS, ROW_SEGMENTS, SEGMENT_EVERY = 1500, 3, 2048
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class Cell:
    """One direction: ``table`` gives the gates' input of each byte, ``state`` that of the hidden state.

    Rows: update gate, reset gate, new value, HIDDEN each.
    """

    table: np.ndarray
    state: np.ndarray


@dataclass
class Network:
    languages: list[str]
    cells: list[Cell]
    out: list[np.ndarray]
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [p for c in self.cells for p in (c.table, c.state)] + [*self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(cell: Cell, data: np.ndarray, mask: np.ndarray | None, backward: bool, keep: bool = False):
    """Hidden states (time x HIDDEN x batch) of segments ``data`` (time x batch), and the steps if kept."""
    n, h = HIDDEN, np.zeros((HIDDEN, data.shape[1]), np.float32)
    states = np.empty((len(data), *h.shape), np.float32)
    steps: list = [None] * len(data)
    # Halved rows make a sigmoid one tanh.
    half = np.r_[np.full(2 * n, 0.5, np.float32), np.ones(n, np.float32)][:, None]
    table, state = cell.table * half, cell.state * half
    for t in range(len(data) - 1, -1, -1) if backward else range(len(data)):
        x = table.take(data[t], axis=1)
        g = state @ h
        gates = x[: 2 * n]
        gates += g[: 2 * n]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        new = gates[n:] * g[2 * n :]
        new += x[2 * n :]
        np.tanh(new, out=new)
        if keep:
            steps[t] = (gates[:n], gates[n:], new, h, g[2 * n :])
        h = h - new
        h *= gates[:n]
        h += new
        if mask is not None:
            h *= mask[t]
        states[t] = h
    return states, steps


def probabilities(net: Network, data: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """(time x languages x batch)."""
    logits = net.bias[None, :, None]
    for cell, out, backward in zip(net.cells, net.out, (False, True)):
        logits = logits + np.matmul(out, forward(cell, data, mask, backward)[0])
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _backward(cell: Cell, data: np.ndarray, steps: list, slope: np.ndarray, backward: bool):
    """Gradients of the table and of the state weights from the slopes of all hidden states."""
    n, carried = HIDDEN, np.zeros(slope.shape[1:], np.float32)
    inputs = np.empty((len(data), 3 * n, data.shape[1]), np.float32)
    state = np.zeros_like(cell.state)
    for t in range(len(data)) if backward else range(len(data) - 1, -1, -1):
        update, reset, new, before, raw = steps[t]
        d = carried + slope[t]
        d_new = d * (1 - update) * (1 - new * new)
        d_update = d * (before - new) * update * (1 - update)
        d_reset = d_new * raw * reset * (1 - reset)
        gates = np.concatenate([d_update, d_reset, d_new * reset])
        state += gates @ before.T
        carried = d * update + cell.state.T @ gates
        inputs[t, :n], inputs[t, n : 2 * n], inputs[t, 2 * n :] = d_update, d_reset, d_new
    flat, rows = data.ravel(), inputs.transpose(1, 0, 2).reshape(3 * n, -1)
    return np.array([np.bincount(flat, row, 256) for row in rows], np.float32), state


def train(
    segments: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 256, rate: float = 0.02
) -> Network:
    """From byte segments (n x SEGMENT) and their language numbers; every position has its segment's label."""
    rng, k = np.random.default_rng(5), len(languages)

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    cells = [Cell(start(3 * HIDDEN, 256), start(3 * HIDDEN, HIDDEN)) for _ in range(2)]
    net = Network(languages, cells, [start(k, HIDDEN) for _ in range(2)], np.zeros(k, np.float32))
    parameters = net.parameters()
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    total, step = epochs * max(1, -(-len(segments) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(len(segments))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            data = np.ascontiguousarray(segments[some].T)
            runs = [forward(c, data, None, b, keep=True) for c, b in zip(net.cells, (False, True))]
            logits = net.bias[None, :, None] + sum(np.matmul(w, s) for w, (s, _) in zip(net.out, runs))
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[:, labels[some], np.arange(len(some))] -= 1
            error /= error.shape[0] * error.shape[2]
            slopes: list[np.ndarray] = []
            outs: list[np.ndarray] = []
            for cell, w, (states, steps), back in zip(net.cells, net.out, runs, (False, True)):
                outs.append(np.einsum("tkb,thb->kh", error, states))
                slopes.extend(_backward(cell, data, steps, np.matmul(w.T, error), back))
            step += 1
            pace = rate * (1 - step / (total + 1))
            for i, (p, g) in enumerate(zip(parameters, [*slopes, *outs, error.sum((0, 2))])):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.01 * (g * g - second[i])
                p -= pace * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return net


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _segments(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of the segments of texts that lie end to end."""
    n = -(-lengths // SEGMENT)
    borders = np.r_[0, np.cumsum(lengths)]
    owner = np.repeat(np.arange(len(lengths)), n)
    start = borders[owner] + SEGMENT * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return start, np.minimum(start + SEGMENT, borders[owner + 1]), owner


def _labelled(net: Network, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, starts in them, mask, probabilities, whole starts) for batches of segments."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    start, end, owner = _segments(lengths)
    borders = np.r_[0, np.cumsum(lengths)]
    reach = np.arange(SEGMENT)[:, None]
    # Many languages take smaller batches, so that the probabilities' size stays bounded.
    batch = max(1, BATCH * 64 // max(64, len(net.languages)))
    for at in range(0, len(start), batch):
        s, e, o = start[at : at + batch], end[at : at + batch], owner[at : at + batch]
        place = s[None, :] + reach
        mask = place < e[None, :]
        held = np.where(mask, data[np.minimum(place, len(data) - 1)], 0)
        full = None if mask.all() else mask.astype(np.float32)[:, None, :]
        yield o, s - borders[o], mask, probabilities(net, held, full), s


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """(documents x languages) mean probabilities over all bytes; zeros for empty texts."""
    sums = np.zeros((len(texts), len(net.languages)))
    for owner, _, mask, chances, _ in _labelled(net, texts):
        each = np.einsum("tkb,tb->bk", chances, mask.astype(np.float32))
        border = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sums[owner[border]] += np.add.reduceat(each, border, axis=0)
    return sums / np.maximum(sums.sum(1, keepdims=True), 1e-30)


def spans(net: Network, text: bytes) -> list[tuple[int, int, str]]:
    """(first byte, end, language) runs of equally labelled positions of one text."""
    best = np.zeros(len(text), np.int64)
    for _, start, mask, chances, _ in _labelled(net, [text]):
        labels = chances.argmax(1)
        for b, s in enumerate(start):
            n = int(mask[:, b].sum())
            best[s : s + n] = labels[:n, b]
    border = np.flatnonzero(np.r_[True, best[1:] != best[:-1]]) if len(best) else []
    ends = np.r_[border[1:], len(best)] if len(best) else []
    return [(int(a), int(b), net.languages[best[a]]) for a, b in zip(border, ends)]


def label_positions(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, start, stop, lang): every byte of every text labelled, in runs."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield from ((doc_id, *span) for span in spans(net, text or b""))

    return map_rows(docs.select(id_column(docs), blob()), run, "doc_id bigint, start bigint, stop bigint, lang string")


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, row_segments: int = ROW_SEGMENTS, **params) -> Network | None:
    """A network from the rows of ``docs`` with text and lang; None if there are none.

    Of each language about ``sample_rows`` rows by id hash reach the driver: segments spread over the whole
    text, more of a longer one.
    """
    rows = docs.filter(F.col("lang").isNotNull() & (F.octet_length(F.col("text").cast("binary")) > 0))
    counts = rows.groupBy("lang").count().collect()  # one row for each language
    if not counts:
        return None
    rates = [x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.3 * sample_rows / r["count"])))]
    chance = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_003)) / 1_000_003
    taken = rows.filter(chance < F.create_map(*rates)[F.col("lang")])

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, lang, text in rows:
            places = np.linspace(0, max(0, len(text) - SEGMENT), max(row_segments, -(-len(text) // SEGMENT_EVERY))).astype(int)
            for i in sorted(set(places.tolist())):
                yield doc_id, i, lang, text[i : i + SEGMENT]

    held = map_rows(taken.select(id_column(docs), "lang", blob()), cut, "doc_id bigint, place int, lang string, data binary").collect()
    languages = sorted(r["lang"] for r in counts)
    number = {lang: i for i, lang in enumerate(languages)}
    data = np.zeros((len(held), SEGMENT), np.uint8)
    held.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["place"], r["lang"], bytes(r["data"])))
    for i, row in enumerate(held):
        # A short text is repeated to the segment's length.
        raw = bytes(row["data"])
        data[i] = np.frombuffer((raw * -(-SEGMENT // len(raw)))[:SEGMENT], np.uint8)
    return train(data, np.array([number[r["lang"]] for r in held]), languages, **params)


def identify(docs: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Texts that are null or hold no letter, and all texts if no language could be learned, are ``und``
    with score 0. Null ids are held out of learning; repeated rows are labelled each; an empty table gives
    an empty result; other columns are ignored.
    """
    net = fit(docs.filter(~held_out(3, 1)), **params)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[1] or b"")
            if size >= 4 * BATCH * SEGMENT:
                yield from predicted(held)
                held, size = [], 0
        if held:
            yield from predicted(held)

    def predicted(held: list[tuple]) -> Iterator[tuple]:
        texts = [text if text and has_letter(text) else b"" for _, text in held]
        chances = pooled(net, texts) if net is not None and any(texts) else None
        for i, (doc_id, _) in enumerate(held):
            if chances is None or not texts[i]:
                yield doc_id, UNKNOWN, 0.0
            else:
                k = int(chances[i].argmax())
                yield doc_id, net.languages[k], float(min(1.0, chances[i, k]))

    return map_rows(docs.select(id_column(docs), blob()), run, "doc_id bigint, lang_pred string, score double").select(
        "doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score"
    )
