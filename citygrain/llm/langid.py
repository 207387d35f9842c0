"""Language of texts from a convolutional network over bytes.

Texts are cut into windows of a fixed length that overlap by the widest filter. Bytes become short vectors, filters of
several widths slide over them, the largest answer of each filter in the window is kept, and a softmax over those gives the
languages. A text's probabilities are the mean over its windows, by the number of letter bytes. Everything is trained here in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import binary_column, checked_broadcast, map_arrow, remainder, slices

#: Bytes of a window, numbers of a byte's vector, filters of each width.
WINDOW, VECTOR, WIDTHS, FILTERS = 256, 8, (2, 3, 4, 5), 16

#: Bounds of the training sample: documents of all labels together, and windows of a document.
FIT_DOCUMENTS, FIT_WINDOWS = 4000, 3

#: Windows that go through the network together.
BATCH = 64

#: Bytes of text cut into windows together.
BYTES = 4 << 20

#: The answer for texts without a letter.
NONE = "und"

#: What a model may take when it is sent to the tasks.
MODEL_BYTES = 8 << 20

_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


class Network:
    """Byte vectors, filters of all widths side by side (narrow ones end in zeros), and the softmax layer."""

    def __init__(self, labels: list[str], seed: int = 11, window: int = WINDOW):
        random = np.random.default_rng(seed)
        self.labels, self.window, self.reach = labels, window, max(WIDTHS)
        n = FILTERS * len(WIDTHS)
        self.mask = np.zeros((self.reach, VECTOR, n), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(-1, n)
        normal = lambda *shape: random.standard_normal(shape).astype(np.float32)
        self.weights = {
            "bytes": normal(256, VECTOR) * 0.5,
            "filters": normal(*self.mask.shape) * self.mask / np.sqrt(self.mask.sum(0)),
            "bias": np.zeros(n, np.float32),
            "out": normal(n, len(labels)) * 0.1,
            "shift": np.zeros(len(labels), np.float32),
        }

    def nbytes(self) -> int:
        return self.mask.nbytes + sum(w.nbytes for w in self.weights.values()) + sum(map(len, self.labels))

    def answers(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The seen patches (windows, places, numbers) and the filters' answers to them."""
        vectors = self.weights["bytes"][windows]
        n, places = len(windows), self.window - self.reach + 1
        seen = np.lib.stride_tricks.as_strided(
            vectors, (n, places, self.reach * VECTOR), (vectors.strides[0], vectors.strides[1], vectors.itemsize), writeable=False
        )
        return seen, (np.ascontiguousarray(seen).reshape(n * places, -1) @ self.weights["filters"]).reshape(n, places, -1)

    def softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.weights["bias"], 0) @ self.weights["out"] + self.weights["shift"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return self.softmax(self.answers(windows)[1].max(axis=1))

    def loss_and_gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy; only the place of the largest answer of each filter passes a gradient on."""
        w, n = self.weights, len(windows)
        seen, answers = self.answers(windows)
        place = answers.argmax(axis=1)
        hidden = np.maximum(np.take_along_axis(answers, place[:, None], 1)[:, 0] + w["bias"], 0)
        p = self.softmax(hidden - w["bias"])
        loss = -np.log(p[np.arange(n), labels] + 1e-12).mean()
        d = p
        d[np.arange(n), labels] -= 1
        d /= n
        back = (d @ w["out"].T) * (hidden > 0)
        # (windows, filters, numbers): the patch each filter liked best
        liked = seen[np.arange(n)[:, None], place]
        onto = back[:, :, None] * w["filters"].T[None]
        byte = windows[np.arange(n)[:, None, None], place[:, :, None] + np.arange(self.reach)]
        vectors = np.zeros_like(w["bytes"])
        np.add.at(vectors, byte.ravel(), onto.reshape(-1, VECTOR))
        gradients = {
            "bytes": vectors,
            "filters": np.einsum("nf,nfk->kf", back, liked) * self.mask,
            "bias": back.sum(axis=0),
            "out": hidden.T @ d,
            "shift": d.sum(axis=0),
        }
        return float(loss), gradients

    def train(self, windows: np.ndarray, labels: np.ndarray, rounds: int = 3, rate: float = 0.004, seed: int = 5):
        """Adam with a rate that falls to zero; every window is seen once a round."""
        random = np.random.default_rng(seed)
        steps = rounds * -(-len(windows) // BATCH)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        at = 0
        for _ in range(rounds):
            order = random.permutation(len(windows))
            for a in range(0, len(order), BATCH):
                some = order[a : a + BATCH]
                _, gradients = self.loss_and_gradients(windows[some], labels[some])
                at += 1
                for k, g in gradients.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    step = (first[k] / (1 - 0.9**at)) / (np.sqrt(second[k] / (1 - 0.99**at)) + 1e-8)
                    self.weights[k] -= (rate * (1 - (at - 1) / steps)) * step


def cut(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows in the texts laid end to end, the text of each, and the end of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    step = window - max(WIDTHS) + 1
    counts = np.maximum(1, -(-(sizes - window + step) // step))
    text = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return (ends - sizes)[text] + step * number, text, ends


def windows_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The bytes from the starts on, zero beyond the ends; ``data`` is a window longer than the texts."""
    rows = np.lib.stride_tricks.sliding_window_view(data, window)[starts]
    return np.where(np.arange(window) < (ends - starts)[:, None], rows, 0)


def _laid(texts: list[bytes], window: int) -> np.ndarray:
    return np.frombuffer(b"".join(texts) + bytes(window), np.uint8)


def text_probabilities(network: Network, texts: list[bytes]) -> np.ndarray:
    """For each text the mean of its windows' probabilities, by their letter bytes; zeros without any."""
    out = np.zeros((len(texts), len(network.labels)))
    data = _laid(texts, network.window)
    starts, text, ends = cut(texts, network.window)
    weights = np.zeros(len(texts))
    for a in range(0, len(starts), BATCH):
        part = text[a : a + BATCH]
        rows = windows_at(data, starts[a : a + BATCH], ends[part], network.window)
        letters = _LETTER[rows].sum(axis=1).astype(float)
        np.add.at(out, part, network.probabilities(rows) * letters[:, None])
        np.add.at(weights, part, letters)
    return out / np.maximum(weights, 1)[:, None]


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is kept out of training."""
    return remainder(doc_id, 3) == 1


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def sample_windows(docs: DataFrame, train: Column, documents: int = FIT_DOCUMENTS, windows: int = FIT_WINDOWS) -> list[tuple[str, bytes]]:
    """Distinct (label, window) pairs of about ``documents`` labelled documents, the same share for every label.

    Documents are drawn by a hash of id and text against the share that their label needs, so no label, however common, is
    gathered or sorted, and the sample does not depend on how rows lie.
    """
    labelled = docs.where(train & F.col("lang").isNotNull())
    # one row per language
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    if not counts:
        return []
    each = -(-documents // len(counts))
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, each / n))])
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id", "text"), 11) / float(1 << 53)
    chosen = labelled.where(drawn < share[F.col("lang")]).where(_has_letter())

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"lang": [], "window": []}
            for label, text in zip(batch.column("lang").to_pylist(), binary_column(batch, "text")):
                starts, _, _ = cut([text])
                random = np.random.default_rng(xxhash.xxh3_64_intdigest(text))
                for at in random.permutation(starts)[:windows].tolist():
                    out["lang"].append(label)
                    out["window"].append(text[at : at + WINDOW])
            yield out

    found = map_arrow(chosen.select("lang", "text"), run, "lang string, window binary").distinct()
    # bounded by the documents drawn, their windows and the length of those
    return sorted((r.lang, bytes(r.window)) for r in found.toLocalIterator())


def fit(docs: DataFrame, train: Column, documents: int = FIT_DOCUMENTS, windows: int = FIT_WINDOWS, rounds: int = 3) -> Network | None:
    """A network for the languages of ``docs`` (doc_id, text, lang) among rows where ``train`` holds; None without any.

    Null languages, null texts and texts without letters teach nothing. The sample is bounded by ``documents`` and ``windows``.
    """
    sample = sample_windows(docs, train, documents, windows)
    if not sample:
        return None
    labels = sorted({label for label, _ in sample})
    rows = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for _, w in sample), np.uint8).reshape(-1, WINDOW)
    network = Network(labels)
    if len(labels) > 1:
        network.train(rows, np.searchsorted(labels, [label for label, _ in sample]), rounds)
    return network


def identify(docs: DataFrame, network: Network | None, carried: list[str] | None = None) -> DataFrame:
    """The ``carried`` columns, lang_pred and score (0 to 1): one row per row of ``docs``.

    All windows of the whole text are scored. Texts that are null, empty or without a letter, and all texts if there is no network,
    get ``und`` and 0. Only the text is read for the prediction; repeated rows get equal answers; extra columns are not read.
    """
    carried = carried or ["doc_id"]
    size = network.nbytes() if network else 0
    shared = checked_broadcast(docs.sparkSession, network, size, MODEL_BYTES, "network")

    def run(batches) -> Iterator[dict]:
        network = shared.value
        for batch in batches:
            texts = [t if some else b"" for t, some in zip(binary_column(batch, "text"), batch.column("_letter").to_pylist())]
            for a, b in slices([len(t) for t in texts], BYTES):
                names, scores = [NONE] * (b - a), [0.0] * (b - a)
                known = [i for i in range(a, b) if texts[i]] if network else []
                if known:
                    p = text_probabilities(network, [texts[i] for i in known])
                    for i, best, score in zip(known, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                        names[i - a], scores[i - a] = network.labels[best], min(1.0, score)
                yield {c: batch.column(c).slice(a, b - a) for c in carried} | {"lang_pred": names, "score": scores}

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return map_arrow(docs.select("text", _has_letter().alias("_letter"), *carried), run, f"{kinds}lang_pred string, score double")
