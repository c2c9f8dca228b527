"""Toxicity by the nearest labelled examples.

Labelled examples are vectors of TF-IDF weights over all their words; document frequencies are those of all documents, and norms are
taken over whole texts. The examples lie in an inverted index cut into blocks. For each block and term the index
holds the largest weight, so a query's terms give an upper bound of the cosine to any example of a block. The blocks with the
highest bounds are scored first; then those whose bound reaches the k-th best cosine so far: the neighbours are exactly those of a
full scan.

Neighbours vote by their distance alone: a vote weighs a power of the cosine, and the share of the votes for label 1 is
calibrated by isotonic regression on the examples themselves, each scored without itself. The number of neighbours and the
power are those that tell the classes of the examples apart best, likewise without themselves.

Votes need the query's vector up to a factor, so its norm over the terms that examples or many documents hold is enough. What its other
terms add to the norm is joined to the rows afterwards, for the cosines that are shown as evidence.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, give_back, map_texts, materialize, small_batches
from .labelled import bounded_texts, class_counts, copy_bands, sample_labels, without_copies

#: Remainder of crc32(doc_id) modulo HELD_OUT[0] whose labels are never used.
HELD_OUT = (4, 2)
#: Labelled rows of each class at most, and bytes of their texts together; examples in a block.
EXAMPLES, EXAMPLE_BYTES, BLOCK = 3000, 64 << 20, 64
#: Numbers of neighbours and powers of the cosine to choose from.
NEIGHBOURS, POWERS = (20, 50, 100), (1, 2, 4)
#: Terms of the most examples, whose weights lie in dense blocks; the others lie in postings.
DENSE = 512
#: Blocks that a query scores before it has a k-th best; queries that are searched together.
FIRST, TOGETHER = 4, 128
#: Terms in more than one of so many documents go to each task; there are as many times this as a document has terms, at most.
SHARED_BY = 1000
#: Terms that a task counts before it hands its counts on.
COUNTED_AT_ONCE = 300_000
_TERM = re.compile(r"\w+")


def term_counts(text: str | None) -> dict[str, int]:
    """Words of the whole text in lower case, each with its number. None for null and empty texts."""
    return Counter(_TERM.findall((text or "").lower()))


def inverse_frequency(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.log((1 + n_docs) / (1 + df)) + 1


def document_frequencies(docs: DataFrame) -> DataFrame:
    """term, df: in how many of all documents each term occurs. Tasks count before the exchange."""

    def run(batches):
        import pyarrow as pa

        held: Counter = Counter()
        make = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["term", "df"])
        for batch in batches:
            for text in batch.column(0):
                held.update(set(_TERM.findall((text.as_py() or "").lower())))
                if len(held) >= COUNTED_AT_ONCE:
                    yield make()
                    held.clear()
        yield make()
        held.clear()
        give_back()

    small_batches(docs)
    return docs.select("text").mapInArrow(run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


@dataclass
class BlockMaxIndex:
    """Inverted index of unit vectors in blocks; ``search`` is exact."""

    n: int
    order: np.ndarray  # the caller's number of each example
    row: np.ndarray  # of each term in the dense blocks, or -1
    dense: np.ndarray  # blocks x dense terms x places: weights
    bound: np.ndarray  # dense terms x blocks: the largest weight
    starts: np.ndarray  # of each other term in the postings
    example: np.ndarray  # postings: place in the order
    weight: np.ndarray
    rows: np.ndarray  # places x dense terms: the dense weights once more, in double precision

    @classmethod
    def build(cls, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> BlockMaxIndex:
        n, sizes = len(vectors), np.array([len(t) for t, _ in vectors], np.int64)
        terms = np.concatenate([t for t, _ in vectors]).astype(np.intp) if n else np.zeros(0, np.intp)
        df = np.bincount(terms, minlength=n_terms)
        often = np.argsort(-df, kind="stable")[:DENSE]
        row = np.full(max(n_terms, 1), -1, np.int32)
        row[often] = np.arange(len(often))
        # Examples whose heaviest dense term is the same stand together, which keeps the blocks' bounds tight.
        lead = []
        for i, (t, w) in enumerate(vectors):
            own = np.flatnonzero(row[t] >= 0) if len(t) else ()
            lead.append((int(t[own[np.argmax(w[own])]]) if len(own) else n_terms, i))
        order = np.array([i for _, i in sorted(lead)], np.int64)
        n_blocks = max(1, -(-n // BLOCK))
        terms = np.concatenate([vectors[i][0] for i in order]).astype(np.intp) if n else terms
        weights = np.concatenate([vectors[i][1] for i in order]) if n else np.zeros(0)
        at = np.repeat(np.arange(n), sizes[order]) if n else np.zeros(0, np.int64)
        dense = np.zeros((n_blocks, max(1, len(often)), BLOCK), np.float32)
        held = row[terms] >= 0
        dense[at[held] // BLOCK, row[terms[held]], at[held] % BLOCK] = weights[held]
        rows = np.zeros((n, max(1, len(often))))
        rows[at[held], row[terms[held]]] = weights[held]
        rest = np.flatnonzero(~held)
        rest = rest[np.argsort(terms[rest], kind="stable")]
        starts = np.concatenate(([0], np.cumsum(np.bincount(terms[rest], minlength=max(n_terms, 1)))))
        return cls(n, order, row, dense, np.ascontiguousarray(dense.max(2).T), starts, at[rest], weights[rest], rows)

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """For each query (terms, weights) the numbers and cosines of the k nearest examples with a cosine above 0 (ties: the
        smaller number first), and how many blocks were scored.

        ``skip``: an example for each query that is none of its neighbours. Scores are summed in single precision, so bounds get a
        margin, and whoever may be among the k is summed again in double precision.
        """
        out = []
        for at in range(0, len(queries), TOGETHER):
            out += self._search(queries[at : at + TOGETHER], k, (skip or [-1] * len(queries))[at : at + TOGETHER])
        return out

    def _search(self, queries, k, skip):
        m, n_blocks = len(queries), len(self.dense)
        width = n_blocks * BLOCK
        who = np.repeat(np.arange(m), [len(t) for t, _ in queries])
        terms = np.concatenate([t for t, _ in queries]).astype(np.int64)
        weights = np.concatenate([w for _, w in queries])
        row = self.row[terms]
        rare = row < 0
        lo, n = self.starts[terms[rare]], self.starts[terms[rare] + 1] - self.starts[terms[rare]]
        post = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        posted = np.bincount(np.repeat(who[rare] * width, n) + self.example[post], np.repeat(weights[rare], n) * self.weight[post], m * width).reshape(m, width)
        score = posted.astype(np.float32).reshape(m, n_blocks, BLOCK)
        exactly = np.zeros((m, self.bound.shape[0]))
        exactly[who[~rare], row[~rare]] = weights[~rare]
        heavy = exactly.astype(np.float32)
        # The postings are added up already, so that their largest sum is the bound of their part.
        bounds = score.max(2) + heavy @ self.bound
        alive = np.zeros((m, n_blocks), bool)

        def score_blocks(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)):
                some = np.flatnonzero(wanted[:, b])
                score[some, b] += heavy[some] @ self.dense[b]
            alive[wanted] = True

        def worst() -> np.ndarray:
            """The k-th best score so far, of those that are not to be skipped at least."""
            known = np.where(alive[:, :, None], score, 0).reshape(m, width)
            return np.maximum(-np.partition(-known, k, axis=1)[:, k], 0) if width > k else np.zeros(m, np.float32)

        first = np.zeros_like(alive)
        np.put_along_axis(first, np.argpartition(-bounds, min(FIRST, n_blocks) - 1, axis=1)[:, :FIRST], True, axis=1)
        score_blocks(first & (bounds > 0))
        score_blocks(~alive & (bounds > 0) & (bounds >= worst()[:, None] - 1e-5))
        least, scored = np.maximum(worst() - 1e-5, 0), alive.sum(1)
        score[~alive] = 0
        near, out = score.reshape(m, width)[:, : self.n] > least[:, None], []
        for i in range(m):
            places = np.flatnonzero(near[i])
            if not len(places):
                out.append((np.zeros(0, np.int64), np.zeros(0), int(scored[i])))
                continue
            exact = posted[i, places] + self.rows[places] @ exactly[i]
            number = self.order[places]
            mine = (number != skip[i]) & (exact > 0)
            number, exact = number[mine], exact[mine]
            top = np.lexsort((number, -np.round(exact, 12)))[:k]
            out.append((number[top], exact[top], int(scored[i])))
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y to x (pool adjacent violators)."""
    xs, where = np.unique(x, return_inverse=True)
    total, count = np.bincount(where, y), np.bincount(where).astype(float)
    level, weight, width = [], [], []
    for t, c in zip(total, count):
        level.append(t / c)
        weight.append(c)
        width.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            w = weight[-2] + weight[-1]
            level[-2:] = [(level[-2] * weight[-2] + level[-1] * weight[-1]) / w]
            weight[-2:], width[-2:] = [w], [width[-2] + width[-1]]
    return xs, np.repeat(level, width)


def separation(x: np.ndarray, y: np.ndarray) -> float:
    """The chance that a row of label 1 has a larger x than one of label 0; ties count half."""
    _, where, count = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[where]
    ones = int(y.sum())
    return float((rank[y == 1].sum() - ones * (ones + 1) / 2) / max(1, ones * (len(y) - ones)))


_built: dict[str, ToxicityModel] = {}


def _restored(key: str, state: tuple) -> ToxicityModel:
    """The model of a task; a Python worker builds its index once for all its tasks."""
    if key not in _built:
        _built.clear()
        _built[key] = ToxicityModel(key, *state)
    return _built[key]


class ToxicityModel:
    """``frequencies`` (term, df of all documents) stays with the driver; tasks get what the others hold."""

    def __init__(self, key: str, n_docs: int, words: str, df: np.ndarray, more: str, more_df: np.ndarray, examples: tuple[np.ndarray, ...], rows: dict[int, int], fitted=None, frequencies: DataFrame | None = None):
        """words: the examples' terms, by lines; more: other frequent terms; examples: ids, labels, sizes, terms, counts."""
        self.key, self.n_docs, self.frequencies = key, n_docs, frequencies
        self.state = n_docs, words, df, more, more_df, examples, rows
        self.n_terms = len(df) if words else 0
        self.terms = {t: i for i, t in enumerate([*(words.split("\n") if words else ()), *(more.split("\n") if more else ())])}
        self.idf = inverse_frequency(n_docs, np.concatenate((df[: self.n_terms], more_df)))
        self.ids, self.labels, sizes, terms, counts = examples
        n = np.bincount(self.labels, minlength=2).astype(float)
        self.importance = np.array([rows[y] / n[y] if n[y] else 0.0 for y in (0, 1)])  # by class: how many rows of all an example stands for
        self.base = n[1] / max(1.0, n.sum())
        self._index: BlockMaxIndex | None = None
        self.fitted = fitted or self.fit()
        self.neighbours, self.power, self.knots = self.fitted
        if fitted is None:  # the driver scores nothing as a rule
            self._index = None

    def __reduce__(self):
        return _restored, (self.key, (*self.state, self.fitted))

    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        _, _, sizes, terms, counts = self.state[5]
        return [self.vector(terms[e - m : e], counts[e - m : e]) for m, e in zip(sizes, np.cumsum(sizes))]

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            self._index = BlockMaxIndex.build(self.vectors(), self.n_terms)
        return self._index

    def fit(self) -> tuple[int, float, tuple[np.ndarray, np.ndarray]]:
        """Number of neighbours, power of the cosine, and knots from the share of votes to the score."""
        if not len(self.labels):
            return NEIGHBOURS[0], POWERS[0], (np.zeros(1), np.zeros(1))
        vectors = self.vectors()
        # A bounded number of examples, dealt over the sample, is enough.
        used = list(range(0, len(self.labels), max(1, len(self.labels) // 2000)))
        found = self.index.search([vectors[i] for i in used], max(NEIGHBOURS), used)
        y, best = self.labels[used], None
        for k in NEIGHBOURS:
            for power in POWERS:
                raw = np.array([self.share(near[:k], cosine[:k], power) for near, cosine, _ in found])
                apart = round(separation(raw, y), 4)
                if best is None or apart > best[0]:
                    best = apart, k, power, raw
        _, k, power, raw = best
        weight = np.maximum(1, np.round(4 * self.importance[y] / max(self.importance.max(), 1e-9))).astype(int)
        xs, level = isotonic(np.repeat(raw, weight), np.repeat(y, weight).astype(float))
        return k, power, (xs, np.clip(level, 0.5 / (1 + len(raw)), 1 - 0.5 / (1 + len(raw))))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms, and their weights of norm 1."""
        w = (1 + np.log(counts)) * self.idf[terms]
        return terms, w / np.sqrt(w @ w) if len(w) else w

    def share(self, near: np.ndarray, cosine: np.ndarray, power: float) -> float:
        """The share of the votes for label 1; without neighbours the part of label 1 among the examples."""
        vote = cosine**power
        return float(vote @ self.labels[near] / vote.sum()) if len(near) else float(self.base)

    def score_many(self, texts: list[str | None], shown: bool = True) -> list[tuple[float, list[tuple[int, int, float]], float, list[tuple[str, float]]]]:
        """For each text: score, neighbours, squared norm over the known terms, the other terms with their squared term frequency weights.

        Neighbours are (id, label, cosine), the cosine over the norm of the known terms. Only if ``shown`` is set, neighbours and other terms are listed.
        """
        queries, whole, rest = [], [], []
        for text in texts:
            counts = term_counts(text)
            place = np.fromiter(map(self.terms.get, counts, [-1] * len(counts)), np.int64, len(counts))
            frequency = 1 + np.log(np.fromiter(counts.values(), float, len(counts)))
            known = place >= 0
            weight = frequency[known] * self.idf[place[known]]
            mine = place[known] < self.n_terms
            heft = weight[mine]
            own = float(heft @ heft)
            queries.append((place[known][mine], heft / np.sqrt(own) if own else heft))
            whole.append((own, float(weight @ weight)))
            rest.append([(t, float(f) ** 2) for t, f, k in zip(counts, frequency, known) if not k] if shown and not known.all() else [])
        out = []
        for (near, cosine, _), (own, square), others in zip(self.index.search(queries, self.neighbours) if queries else [], whole, rest):
            shrink = np.sqrt(own / square) if square else 1.0
            score = float(np.interp(self.share(near, cosine, self.power), *self.knots))
            out.append((score, [(int(self.ids[i]), int(self.labels[i]), float(c * shrink)) for i, c in zip(near, cosine)] if shown else [], square, others))
        return out


def fit_model(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learns from EXAMPLES labelled rows of each class at most, by the document frequencies of all ``docs``. Copies among the examples count once.

    Without labelled rows the model gives every text the score 0. What reaches the driver is bounded by the sample (its rows' terms and
    their numbers, from EXAMPLE_BYTES of text at most) and by the number of terms that more than one in SHARED_BY documents can hold.
    """
    rows = class_counts(labels, "toxic", *HELD_OUT)
    sample = bounded_texts(sample_labels(labels, "toxic", *HELD_OUT, EXAMPLES), docs, EXAMPLE_BYTES)

    def counted(text):
        counts = term_counts(text)
        return copy_bands(text), list(counts), list(counts.values())

    found = map_texts(sample, ["doc_id", "label"], lambda: counted, "bands array<long>, terms array<string>, counts array<int>").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    heads = found.select(["doc_id", "label", "bands"]).to_pylist()
    kept = without_copies([(r["doc_id"], r["label"], r["bands"]) for r in heads])
    numbers: dict[str, int] = {}
    parts: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for i, r in enumerate(heads):
        if r["doc_id"] in kept:
            terms, counts = found.column("terms")[i].as_py(), found.column("counts")[i].as_py()
            parts.append((r["doc_id"], r["label"], np.array([numbers.setdefault(t, len(numbers)) for t in terms], np.int32), np.array(counts, np.int32)))
    del found
    join = lambda k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int32)
    examples = np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64), np.array([len(p[2]) for p in parts], np.int64), join(2), join(3)

    frequencies = materialize(document_frequencies(docs), "toxicity-frequencies")
    n_docs = docs.count()
    least, wanted = n_docs / SHARED_BY, "\n".join(numbers)

    def shared(batches):
        import pyarrow as pa

        known = set(wanted.split("\n"))
        for batch in batches:
            yield batch.filter(pa.array([t in known or n > least for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], pa.bool_()))

    table = frequencies.mapInArrow(shared, frequencies.schema).toArrow()
    df, more = np.ones(len(numbers)), {}
    for t, n in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
        if t in numbers:
            df[numbers[t]] = n
        else:
            more[t] = n
    model = ToxicityModel(uuid.uuid4().hex, n_docs, wanted, df, "\n".join(more), np.array(list(more.values()), float), examples, rows, None, frequencies)
    del parts, numbers, table, more
    give_back()
    return model


SCORE_SCHEMA = "score double, evidence array<struct<doc_id: long, label: int, similarity: double>>"


def score_texts(df: DataFrame, keep: list[str], model: ToxicityModel, evidence: int = 3) -> DataFrame:
    """``keep``, then the score of each row's ``text`` and its nearest labelled examples.

    Null, empty and wordless texts get the score of the base rate and no evidence; so do texts without a term that any example
    holds. ``evidence``: neighbours that are shown for each row; without any, no norms need be joined. Texts are read whole, whatever their length; repeated rows come out repeated, with equal values; among equally near
    examples the one with the smaller id stands first. An empty frame gives no rows, an empty table of labels the score 0 for all.
    Columns that are not in ``keep`` are dropped, whatever their names.
    """

    def make():
        def run(rows):
            found = model.score_many([text for text, in rows], evidence > 0)
            return [(value, [{"doc_id": d, "label": y, "similarity": s} for d, y, s in near[:evidence]], square, [{"term": t, "w": w} for t, w in rest] if near else []) for value, near, square, rest in found]

        return run

    if not evidence:
        plain = map_texts(df.select(*keep, F.col("text").alias("scored_text")), keep, make, f"{SCORE_SCHEMA}, unused double, rest array<struct<term: string, w: double>>", many=True)
        return plain.select(*keep, "score", "evidence")
    row, square, rest, more = (free_name(df, x) for x in ("row_number", "square", "rest", "more"))
    numbered = df.select(*keep, F.monotonically_increasing_id().alias(row), F.col("text").alias("scored_text"))
    scored = materialize(map_texts(numbered, [*keep, row], make, f"{SCORE_SCHEMA}, {square} double, {rest} array<struct<term: string, w: double>>", many=True), "toxicity-scores")
    # Terms that neither an example nor many documents hold: none of them is in more than one of SHARED_BY documents.
    held = scored.select(F.col(row), F.explode(rest).alias("t")).select(row, "t.term", "t.w").join(model.frequencies, "term", "left")
    idf = F.log((1 + F.lit(float(model.n_docs))) / (1 + F.coalesce("df", F.lit(0)))) + 1
    added = held.groupBy(row).agg(F.sum(F.col("w") * idf * idf).alias(more))
    shrink = F.when(F.col(square) > 0, F.sqrt(F.col(square) / (F.col(square) + F.coalesce(more, F.lit(0.0))))).otherwise(1.0)
    whole = F.transform("evidence", lambda e: e.withField("similarity", e["similarity"] * shrink))
    return scored.drop(rest).join(added, row, "left").select(*keep, "score", whole.alias("evidence"))
