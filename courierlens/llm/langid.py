"""Language of texts by a bidirectional gated recurrent network over bytes.

A text's bytes are read in segments of fixed length; a forward and a backward recurrent
layer label every byte, and a text's probabilities are the mean over all its bytes. The
network is trained in numpy by backpropagation through time. Its gates use the soft sign
x / (1 + |x|), whose derivative needs only its value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.blocks import flat, slices

UNKNOWN = "und"
HIDDEN = 8
SEGMENT = 96
PAD = 256
# bytes of text in one forward pass
PASS_BYTES = 1 << 18


@dataclass(frozen=True)
class Training:
    """Bounds on the labelled sample, and the training schedule."""

    texts_per_language: int = 400
    chars_per_text: int = 1000
    steps: int = 180
    batch: int = 192
    rate: float = 0.02
    seed: int = 11


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Layer:
    """One direction: update gate z, reset gate r, candidate n; state h' = h + z (n - h).

    ``table`` maps a byte to the gates' inputs (3 x HIDDEN); all arrays have the batch last.
    """

    def __init__(self, params: dict[str, np.ndarray], name: str) -> None:
        self.table, self.gates, self.cand = (params[f"{name}_{k}"] for k in ("table", "gates", "cand"))

    def run(self, x: np.ndarray, live: np.ndarray | None, trace: list | None = None) -> Iterator[np.ndarray]:
        """States after each row of ``x`` (time x batch); rows where ``live`` is 0 reset them."""
        h = np.zeros((HIDDEN, x.shape[1]), np.float32)
        for t in range(len(x)):
            a = np.take(self.table, x[t], axis=1, mode="clip")
            s = a[: 2 * HIDDEN]
            s += self.gates @ h
            s /= 1 + np.abs(s)
            zr = 0.5 * s + 0.5
            z, r = zr[:HIDDEN], zr[HIDDEN:]
            n = a[2 * HIDDEN :]
            n += self.cand @ (r * h)
            n /= 1 + np.abs(n)
            if trace is not None:
                trace.append((h, s, zr, n))
            h = h + z * (n - h)
            if live is not None:
                h *= live[t]
            yield h

    def back(self, x: np.ndarray, trace: list, dstates: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from those of the states, by backpropagation through time."""
        dgates, dcand = np.zeros_like(self.gates), np.zeros_like(self.cand)
        inputs = np.empty((len(x), 3 * HIDDEN, x.shape[1]), np.float32)
        carry = np.zeros_like(dstates[0])
        for t in reversed(range(len(x))):
            h, s, zr, n = trace[t]
            z, r = zr[:HIDDEN], zr[HIDDEN:]
            d = dstates[t] + carry
            dn = d * z * (1 - np.abs(n)) ** 2
            back = self.cand.T @ dn
            ds = np.concatenate([d * (n - h), back * h]) * (0.5 * (1 - np.abs(s)) ** 2)
            dcand += dn @ (r * h).T
            dgates += ds @ h.T
            carry = d * (1 - z) + back * r + self.gates.T @ ds
            inputs[t, : 2 * HIDDEN], inputs[t, 2 * HIDDEN :] = ds, dn
        flat_x, rows = x.ravel(), inputs.transpose(1, 0, 2).reshape(3 * HIDDEN, -1)
        dtable = np.stack([np.bincount(flat_x, w, minlength=PAD + 1) for w in rows]).astype(np.float32)
        return {"table": dtable, "gates": dgates, "cand": dcand}


def softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(axis=-2, keepdims=True))
    a /= a.sum(axis=-2, keepdims=True)
    return a


def label_bytes(params: dict[str, np.ndarray], x: np.ndarray, live: np.ndarray | None) -> np.ndarray:
    """Probabilities of every byte: time x class x batch."""
    out = np.empty((len(x), len(params["bias"]), x.shape[1]), np.float32)
    flipped = None if live is None else live[::-1]
    for t, h in enumerate(Layer(params, "fore").run(x, live)):
        np.matmul(params["fore_out"], h, out=out[t])
    for t, h in enumerate(Layer(params, "hind").run(x[::-1], flipped)):
        out[len(x) - 1 - t] += params["hind_out"] @ h
    out += params["bias"][:, None]
    return softmax(out)


def _start(classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    params = {"bias": np.zeros(classes, np.float32)}
    for name in ("fore", "hind"):
        params[f"{name}_table"] = draw(3 * HIDDEN, PAD + 1, scale=0.5)
        params[f"{name}_gates"] = draw(2 * HIDDEN, HIDDEN, scale=0.3)
        params[f"{name}_cand"] = draw(HIDDEN, HIDDEN, scale=0.3)
        params[f"{name}_out"] = draw(classes, HIDDEN, scale=0.3)
    return params


def gradients(params: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradients and mean cross-entropy of labelling every byte of column i with class y[i]."""
    sides = {}
    for name, seen in (("fore", x), ("hind", x[::-1])):
        trace: list = []
        layer = Layer(params, name)
        states = np.stack(list(layer.run(seen, None, trace)))
        sides[name] = (layer, seen, trace, states)
    logits = params["fore_out"] @ sides["fore"][3] + (params["hind_out"] @ sides["hind"][3])[::-1]
    p = softmax(logits + params["bias"][:, None])
    columns = np.arange(x.shape[1])
    loss = -float(np.log(p[:, y, columns] + 1e-9).mean())
    p[:, y, columns] -= 1
    p /= x.size
    found = {"bias": p.sum(axis=(0, 2))}
    for name, (layer, seen, trace, states) in sides.items():
        d = p if name == "fore" else p[::-1]
        found[f"{name}_out"] = np.einsum("tcb,thb->ch", d, states, optimize=True)
        for key, g in layer.back(seen, trace, params[f"{name}_out"].T @ d).items():
            found[f"{name}_{key}"] = g
    return found, loss


def train(texts: list[tuple[bytes, str]], settings: Training) -> tuple[list[str], dict[str, np.ndarray]]:
    """Classes and parameters, by Adam over random segments drawn evenly from the languages."""
    by_class: dict[str, list[np.ndarray]] = {}
    for text, lang in sorted(texts):
        if len(text) >= 1:
            by_class.setdefault(lang, []).append(np.frombuffer(text, np.uint8))
    classes = sorted(by_class)
    rng = np.random.default_rng(settings.seed)
    params = _start(max(len(classes), 1), rng)
    if len(classes) < 2:
        return classes, params
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    joined = {c: np.concatenate(by_class[c]) for c in classes}
    for step in range(1, settings.steps + 1):
        y = rng.integers(0, len(classes), settings.batch)
        x = np.empty((SEGMENT, settings.batch), np.int64)
        for i, c in enumerate(y):
            pool = joined[classes[c]]
            at = int(rng.integers(0, max(len(pool) - SEGMENT, 0) + 1))
            x[:, i] = np.resize(pool[at : at + SEGMENT], SEGMENT)
        found, _ = gradients(params, x, y)
        norm = float(np.sqrt(sum(float((g**2).sum()) for g in found.values())))
        rate = settings.rate * min(1.0, 2 * (1 - step / (settings.steps + 1)))
        for k, g in found.items():
            g = g.astype(np.float32) * min(1.0, 1.0 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return classes, {k: v.astype(np.float32) for k, v in params.items()}


def labelled_sample(docs: DataFrame, settings: Training) -> list[tuple[bytes, str]]:
    """At most ``texts_per_language`` pieces of ``chars_per_text`` from every language.

    Only rows that are not held out and have a language and a letter are read; which of
    them, and which of their pieces, a hash of the id decides.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # one row per language
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return []
    # twice the wished share by hash, cut to the bound below
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, 2.0 * settings.texts_per_language / r.n)])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    last = F.greatest(F.length("text") - settings.chars_per_text, F.lit(0))
    piece = F.substr("text", F.lit(1) + F.pmod(F.xxhash64("doc_id"), last + 1).cast("int"), F.lit(settings.chars_per_text))
    some = usable.where(draw < share[F.col("lang")]).where(has_letter(F.col("text")))
    kept: dict[str, list[tuple[bytes, str]]] = {}
    for r in some.select("lang", draw.alias("draw"), piece.alias("piece")).collect():
        kept.setdefault(r.lang, []).append((r.draw, r.piece.encode(), r.lang))
    return [t[1:] for found in kept.values() for t in sorted(found)[: settings.texts_per_language]]


def learn_languages(docs: DataFrame, settings: Training | None = None) -> tuple[list[str], dict[str, np.ndarray]]:
    settings = settings or Training()
    return train(labelled_sample(docs, settings), settings)


def pooled(params: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over the bytes of each row of the labels' probabilities: row x class."""
    sizes = np.diff(offsets)
    pieces = -(-sizes // SEGMENT)
    row = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = offsets[:-1][row] + nth * SEGMENT
    lengths = np.minimum(offsets[1:][row] - starts, SEGMENT)
    places = np.arange(SEGMENT)[:, None]
    inside = places < lengths
    x = np.where(inside, data[np.minimum(starts + places, len(data) - 1)], PAD).astype(np.int64)
    live = inside.astype(np.float32)
    p = np.einsum("tcb,tb->bc", label_bytes(params, x, live), live)
    sums = np.zeros((len(sizes), p.shape[1]))
    np.add.at(sums, row, p)
    return sums


def predict_batch(classes: list[str], params: dict[str, np.ndarray], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers (-1 for an empty text) and scores of each text."""
    data, offsets = flat(column)
    best, score = np.full(len(column), -1), np.zeros(len(column))
    if not classes:
        return best, score
    for a, b in slices(offsets, PASS_BYTES):
        sums = np.zeros((b - a, len(classes)))
        # a longer text runs in several passes, cut at segment ends
        step = PASS_BYTES // SEGMENT * SEGMENT
        if b - a == 1 and offsets[b] - offsets[a] > step:
            for at in range(int(offsets[a]), int(offsets[b]), step):
                part = data[at : min(at + step, int(offsets[b]))]
                sums += pooled(params, part, np.array([0, len(part)]))
        elif offsets[b] > offsets[a]:
            sums = pooled(params, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        total = sums.sum(axis=1)
        full = total > 0
        best[a:b][full] = sums[full].argmax(axis=1)
        score[a:b][full] = sums[full].max(axis=1) / total[full]
    return best, score


def predict_languages(
    docs: DataFrame, model: tuple[list[str], dict[str, np.ndarray]], keep_from: float | None = None
) -> DataFrame:
    """doc_id, held_out, lang_pred and score; with ``keep_from`` the rows themselves that reach that score.

    * ``und`` with score 0: a null text, a text without a letter, or no language learned.
    * Ties go to the first language by name. Texts are read whole, in segments.
    * Repeated rows and null ids (not held out) give a row each; an empty table gives none.
    * Other columns are ignored, or kept with the rows, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, params = shared.value
        values = pa.array([*classes, UNKNOWN])
        for batch in batches:
            letters = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            best, score = predict_batch(classes, params, batch.column("text"))
            known = letters & (best >= 0)
            score = np.where(known, score, 0.0)
            if keep_from is not None:
                rows = batch.select(names)
                yield rows.filter(pa.array(known & (score >= keep_from)))
                continue
            taken = values.take(pa.array(np.where(known, best, len(classes))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), taken, pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    if keep_from is not None:
        # a name that no column of the rows has
        letters = "letters" + "_" * max(map(len, names))
        return docs.select(*names, has_letter(F.col("text")).alias(letters)).mapInArrow(run, docs.schema)
    asked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "text",
        has_letter(F.col("text")).alias("letters"),
    )
    return asked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
