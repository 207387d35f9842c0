"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lower-cases, undoes look-alike letters, accents and digit substitutions, drops invisible characters and
turns everything else into blanks. The lexicon holds whole words and word beginnings; both are learned from
labelled documents. Words inside an exception phrase do not count.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import binary_column, checked_broadcast, map_arrow, remainder

#: A document is toxic from this score on.
THRESHOLD = 0.3

#: Labelled rows that a model is fitted on, about; fewer if there are fewer.
FIT_ROWS = 30_000

#: Terms that a task counts before it passes them on.
HELD = 250_000

#: Lengths of the word beginnings that can enter the lexicon.
STEMS = range(4, 9)

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕһԁԛԝьвнкмтлгαβεηικμνορτυχω",
        "aeopcyxijshdqwbbhkmtnraβεnikμvoptuxw",
    )
) | {"β": "b", "ε": "e", "μ": "u", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe"}

#: Digits and signs that stand for letters.
SUBSTITUTES = dict(zip("0134578@$", "oieastbas"))

#: What an untrained model looks for.
WORDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

#: Phrases in which words of the lexicon are meant literally.
EXCEPTIONS = ("clown fish", "trash bag", "trash bin", "trash can", "loser bracket", "loser pays", "pathetic fallacy")


class _Fold(dict):
    """Character table that fills itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        found = self[code] = self._folded(c)
        return found

    @staticmethod
    def _folded(c: str) -> str:
        if c in SUBSTITUTES:
            return SUBSTITUTES[c]
        if unicodedata.category(c) in ("Cf", "Mn"):
            return ""
        out = []
        for x in unicodedata.normalize("NFKD", c).casefold():
            x = LOOKALIKES.get(x, x)
            if unicodedata.combining(x[0]):
                continue
            out.append(x if x.isalpha() else SUBSTITUTES.get(x, " "))
        return "".join(out) or " "


FOLD = _Fold()


def folded(text: str) -> str:
    """Letters in their plain forms, everything else blank."""
    if len(FOLD) > 1 << 17:
        FOLD.clear()
    return text.translate(FOLD)


@dataclass
class Model:
    """Weights of words (``"idiot "``) and word beginnings (``"idio"``), and how sums become a score."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: constant, weight of the sum of matches, weight of the sum per hundred words
    scale: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            found = ahocorasick.Automaton()
            for term, weight in self.lexicon.items():
                found.add_word(" " + term, (len(term), weight))
            for phrase in self.exceptions:
                found.add_word(f" {folded(phrase)} ", (len(folded(phrase)) + 1, None))
            if len(found):
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def weigh(self, text: str) -> tuple[float, int]:
        """Sum of the matched weights, one match a word at most, and the number of words."""
        plain = " ".join(["", *folded(text).split(), ""])
        automaton = self.automaton()
        if not len(automaton):
            return 0.0, plain.count(" ") - 1
        matches: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(plain):
            start = end - size
            if weight is None:
                covered.append((start, end))
            else:
                matches[start] = max(weight, matches.get(start, 0.0))
        total = sum(w for at, w in matches.items() if not any(a <= at < b for a, b in covered))
        return total, max(0, plain.count(" ") - 1)

    def inputs(self, total: float, words: int) -> tuple[float, float, float]:
        return 1.0, math.log1p(total), math.log1p(100 * total / max(1, words))

    def score(self, text: str) -> float:
        z = sum(a * b for a, b in zip(self.scale, self.inputs(*self.weigh(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def terms(text: str) -> set[str]:
    """The words of a text and their beginnings, each once."""
    out = set()
    for word in set(folded(text).split()):
        out.add(word + " ")
        out.update(word[:n] for n in STEMS if n <= len(word))
    return out


def evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-likelihood ratio of a term's share among toxic and clean documents, 0 where it is rather clean."""
    if toxic * all_clean <= clean * all_toxic:
        return 0.0

    def part(k, n, p):
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log1p(-p) if n > k else 0.0)

    p = (toxic + clean) / (all_toxic + all_clean)
    own = part(toxic, all_toxic, toxic / all_toxic) + part(clean, all_clean, clean / all_clean)
    return own - part(toxic, all_toxic, p) - part(clean, all_clean, p)


def fit(docs: DataFrame, labels: DataFrame, train, rows: int = FIT_ROWS) -> Model:
    """A model learned from the labelled documents for which ``train`` (a column over doc_id) holds.

    About ``rows`` labelled rows are used, picked by a digest of their id; this is the only bound, and their ids are
    what is broadcast. Terms must be more frequent in toxic documents than chance explains among all
    terms tried. Rows without id, label or document are left out; of contradicting labels of one id the larger counts.
    Without labels of both kinds the model is the untrained list.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & train)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = known.count()
    share = min(1.0, rows / max(1, total))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    picked = picked.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
    # about `rows` rows of two numbers
    marked = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    marked = marked.select("text", F.col("_toxic").alias("toxic"))

    def count(batches) -> Iterator[dict]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(binary_column(batch, "text"), batch.column("toxic").to_pylist()):
                seen[toxic][""] += 1
                seen[toxic].update(terms(text.decode("utf-8", "replace")))
                if len(seen[0]) + len(seen[1]) > HELD:
                    yield counted(*seen)
                    seen = Counter(), Counter()
        yield counted(*seen)

    def counted(clean: Counter, toxic: Counter) -> dict:
        every = list(clean.keys() | toxic.keys())
        return {"term": every, "toxic": [toxic[t] for t in every], "clean": [clean[t] for t in every]}

    counts = map_arrow(marked, count, "term string, toxic long, clean long").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 1 or term = ''")
    # terms mostly in toxic documents; chance alone needs log(terms) of evidence
    n = F.broadcast(counts.where("term = ''").select(F.col("toxic").alias("t"), F.col("clean").alias("c")))
    likely = counts.where("term <> ''").crossJoin(n).where("toxic * c > 4 * clean * t")  # n is one row
    summary = likely.agg(F.count("*").alias("n"), F.max("t").alias("t"), F.max("c").alias("c")).first()
    if not summary.n or not summary.t or not summary.c:
        return Model({w + " ": 1.0 for w in WORDS})
    need = math.log(summary.n) + 3
    # a term with this evidence is in so many toxic documents at least, which few are
    least = need / math.log((summary.t + summary.c) / summary.t)
    strong = [(evidence(r.toxic, r.clean, summary.t, summary.c), r) for r in likely.where(F.col("toxic") >= least).toLocalIterator()]
    lexicon: dict[str, float] = {}
    for found, r in sorted((x for x in strong if x[0] > need), key=lambda x: (-x[0], len(x[1].term), x[1].term)):
        word = r.term.strip()
        if any(word.startswith(t.strip()) or t.startswith(word) for t in lexicon):
            continue
        odds = (r.toxic + 0.5) / (summary.t + 1) / ((r.clean + 0.5) / (summary.c + 1))
        lexicon[r.term] = min(6.0, math.log(odds))
    model = Model(lexicon)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def weigh(batches) -> Iterator[dict]:
        model = shared.value
        for batch in batches:
            pairs = [model.weigh(t.decode("utf-8", "replace")) for t in binary_column(batch, "text")]
            yield {"total": [a for a, _ in pairs], "words": [b for _, b in pairs], "toxic": batch.column("toxic")}

    # three numbers for each of about `rows` rows
    points = [(model.inputs(r.total, r.words), r.toxic) for r in map_arrow(marked, weigh, "total double, words long, toxic int").toLocalIterator()]
    model.scale = calibrated(np.array([x for x, _ in points]), np.array([y for _, y in points], float))
    return model


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; weights of the matches are kept from falling below zero."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (p - y) + ridge * b
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(curve, slope)
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    b[1:] = np.maximum(b[1:], 0)
    return tuple(b.tolist())


def score_documents(docs: DataFrame, model: Model, carried: list[str] | None = None) -> DataFrame:
    """doc_id (or the ``carried`` columns) and score: one row per row of ``docs``; a null text counts as empty."""
    size = sum(map(len, model.lexicon)) + sum(map(len, model.exceptions))
    shared = checked_broadcast(docs.sparkSession, model, size, 16 << 20, "lexicon")
    carried = carried or ["doc_id"]

    def run(batches) -> Iterator[dict]:
        model = shared.value
        for batch in batches:
            yield {c: batch.column(c) for c in carried} | {
                "score": [model.score(t.decode("utf-8", "replace")) for t in binary_column(batch, "text")]
            }

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return map_arrow(docs.select("text", *carried), run, f"{kinds}score double")


def held_out(doc_id="doc_id"):
    """Documents that no model learns from."""
    return remainder(doc_id, 4) == 2


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all their columns, with a score below the threshold."""
    whole = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = score_documents(whole, model, ["row"]).where(F.col("score") < threshold)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
