"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word, a space before and after it, in both directions; words of
more than `LONGEST` bytes are read in pieces. It gives every byte a probability for each language,
and a document's probabilities are the means over all bytes of its words. A word means the same
wherever it stands, so a task computes each distinct word once.

It is trained in numpy by backpropagation through time on a bounded sample: `sample_docs` documents
per language, of each an excerpt of `excerpt` characters at a place chosen by hash. All words of the
sample are learned from; batches draw them so that each language comes up alike. A score is above
chance if it is more than a quarter of the way from 1 / languages to the scores of the sample's documents,
of which the lowest hundredth is left aside; one language alone is never rejected.

NULL text and text without a letter are `und` with score 0; so is everything if there is nothing
to learn from. Rows without id are not learned from. Repeated rows get the same result each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.common import row_hash, ship, unit_interval

ship(__name__)

UNKNOWN = "und"
LONGEST = 24
HIDDEN = 12
EMBEDDED = 12
BATCH = 512
STEPS = 900
CHUNK_BYTES = 1 << 21
CACHED_WORDS = 400_000


class Direction:
    """One direction of the network: gates z and r and candidate n, side by side."""

    def __init__(self, rng, embedded: int, hidden: int):
        scale = 1 / np.sqrt(hidden)
        self.w = rng.uniform(-scale, scale, (embedded, 3 * hidden)).astype(np.float32)
        self.u = rng.uniform(-scale, scale, (hidden, 3 * hidden)).astype(np.float32)
        self.b = np.zeros(3 * hidden, np.float32)

    def forward(self, inputs, keep: bool = False):
        """States after each of the inputs (steps of rows x 3 hidden), and what the way back needs."""
        n = self.u.shape[0]
        h = np.zeros((inputs.shape[1], n), np.float32)
        states, kept = [], []
        for x in inputs:
            past = h @ self.u
            gates = x[:, : 2 * n] + past[:, : 2 * n]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :n], gates[:, n:]
            new = np.tanh(x[:, 2 * n :] + r * past[:, 2 * n :])
            if keep:
                kept.append((h, z, r, new, past[:, 2 * n :]))
            h = new + z * (h - new)
            states.append(h)
        return np.stack(states), kept

    def backward(self, grads, kept):
        """Gradients of the inputs and of `u`."""
        n = self.u.shape[0]
        back, du = np.zeros_like(grads[0]), np.zeros_like(self.u)
        inputs = np.zeros((len(grads), grads.shape[1], 3 * n), np.float32)
        for t in range(len(grads) - 1, -1, -1):
            h, z, r, new, past = kept[t]
            g = grads[t] + back
            dn = g * (1 - z) * (1 - new * new)
            dz = g * (h - new) * z * (1 - z)
            dr = dn * past * r * (1 - r)
            inputs[t] = np.concatenate([dz, dr, dn], axis=1)
            through = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ through
            back = g * z + through @ self.u.T
        return inputs, du


class ByteNetwork:
    def __init__(self, languages: list[str], hidden: int = HIDDEN, embedded: int = EMBEDDED, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages, self.rng = languages, rng
        self.least_score = 1 / len(languages) if len(languages) > 1 else 0.0
        self.embedding = rng.normal(0, 0.5, (256, embedded)).astype(np.float32)
        self.sides = [Direction(rng, embedded, hidden) for _ in range(2)]
        self.out = rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Of each language at each position: steps x rows x languages. `codes` is steps x rows."""
        tables = [self.embedding @ d.w + d.b for d in self.sides]
        ahead, _ = self.sides[0].forward(tables[0][codes])
        back, _ = self.sides[1].forward(tables[1][codes[::-1]])
        return self._softmax(np.concatenate([ahead, back[::-1]], axis=2))

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.out + self.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def train(self, words: list[bytes], labels: np.ndarray, steps: int = STEPS, rate: float = 0.01) -> None:
        """Adam on the mean cross entropy of all positions, on batches of words of one length; languages are drawn alike."""
        weight = 1 / np.bincount(labels, minlength=len(self.languages))[labels]
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        lengths = sorted(by_length)
        codes = {n: np.frombuffer(b"".join(words[i] for i in by_length[n]), np.uint8).reshape(-1, n).T for n in lengths}
        answers = {n: labels[by_length[n]] for n in lengths}
        drawn = {n: np.cumsum(weight[by_length[n]]) for n in lengths}
        odds = np.array([n * drawn[n][-1] for n in lengths])
        parameters = [self.embedding, self.out, self.bias] + [p for d in self.sides for p in (d.w, d.u, d.b)]
        first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
        for step in range(1, steps + 1):
            n = lengths[self.rng.choice(len(lengths), p=odds / odds.sum())]
            pick = np.searchsorted(drawn[n][:-1], self.rng.random(BATCH) * drawn[n][-1], side="right")
            grads = self._gradients(codes[n][:, pick], answers[n][pick])
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for p, g, a, b in zip(parameters, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)

    def _gradients(self, codes: np.ndarray, answers: np.ndarray) -> list[np.ndarray]:
        seen = self.embedding[codes]
        ahead, kept_ahead = self.sides[0].forward(seen @ self.sides[0].w + self.sides[0].b, True)
        back, kept_back = self.sides[1].forward(seen[::-1] @ self.sides[1].w + self.sides[1].b, True)
        states = np.concatenate([ahead, back[::-1]], axis=2)
        d = self._softmax(states)
        d[:, np.arange(len(answers)), answers] -= 1
        d /= d.shape[0] * d.shape[1]
        d_states = d @ self.out.T
        n = d_states.shape[2] // 2
        d_embedding, per_side, d_seen = np.zeros_like(self.embedding), [], np.zeros_like(seen)
        for side, grad, kept in ((0, d_states[:, :, :n], kept_ahead), (1, d_states[::-1, :, n:], kept_back)):
            inputs, du = self.sides[side].backward(grad, kept)
            source = seen if side == 0 else seen[::-1]
            per_side += [np.einsum("tbe,tbk->ek", source, inputs), du, inputs.sum(axis=(0, 1))]
            through = inputs @ self.sides[side].w.T
            d_seen += through if side == 0 else through[::-1]
        np.add.at(d_embedding, codes.ravel(), d_seen.reshape(-1, d_seen.shape[2]))
        d_out = np.einsum("tbh,tbc->hc", states, d)
        return [d_embedding, d_out, d.sum(axis=(0, 1)), *per_side]


def framed(word: bytes) -> list[bytes]:
    return [b" " + word[i : i + LONGEST] + b" " for i in range(0, len(word), LONGEST)]


class WordScores(dict):
    """Row number of each word seen, and the sums of its bytes' probabilities."""

    def __init__(self, network: ByteNetwork):
        super().__init__()
        self.network, self.waiting = network, []
        self.sums = np.zeros((0, len(network.languages) + 1), np.float32)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.waiting.append(word)
        return at

    def settle(self) -> np.ndarray:
        """Probability sums, then number of bytes, of all words so far."""
        sizes = np.fromiter(map(len, self.waiting), np.int64, len(self.waiting))
        fresh = np.zeros((len(sizes), self.sums.shape[1]), np.float32)
        fresh[:, -1] = sizes
        words = np.array(self.waiting, dtype=object)
        for n in np.unique(sizes[sizes <= LONGEST]):
            rows = np.flatnonzero(sizes == n)
            for a in range(0, len(rows), 16384):
                part = rows[a : a + 16384]
                fresh[part, :-1] += self._sums(b" " + b"  ".join(words[part]) + b" ", n + 2)
        for row in np.flatnonzero(sizes > LONGEST):
            *full, rest = framed(words[row])
            for a in range(0, len(full), 16384):
                fresh[row, :-1] += self._sums(b"".join(full[a : a + 16384]), LONGEST + 2).sum(axis=0)
            fresh[row, :-1] += self._sums(rest, len(rest))[0]
        self.sums, self.waiting = np.concatenate([self.sums, fresh]), []
        return self.sums

    def _sums(self, pieces: bytes, size: int) -> np.ndarray:
        """Sums over the bytes of framed pieces of one size, without the frame's."""
        codes = np.frombuffer(pieces, np.uint8).reshape(-1, size).T
        return self.network.probabilities(codes)[1:-1].sum(axis=0)


def labelled(batches, network: ByteNetwork):
    """Language and score of every row."""
    known = WordScores(network)
    for batch in batches:
        pooled = np.zeros((batch.num_rows, len(network.languages) + 1))
        texts, lettered = batch.column("_bytes"), batch.column("_lettered").to_numpy(zero_copy_only=False)
        waiting: list[tuple[int, np.ndarray]] = []

        def settle():
            sums = known.settle()
            for row, words in waiting:
                pooled[row] += sums[words].sum(axis=0)
            waiting.clear()

        size = 0
        for row in np.flatnonzero(lettered):
            text = texts[row].as_py()
            for a in range(0, len(text), CHUNK_BYTES):
                words = text[a : a + CHUNK_BYTES].split()
                waiting.append((row, np.fromiter(map(known.__getitem__, words), np.int64, len(words))))
                size += min(len(text) - a, CHUNK_BYTES)
                if size >= CHUNK_BYTES:
                    settle()
                    size = 0
                    if len(known) > CACHED_WORDS:
                        known = WordScores(network)
        settle()
        means = pooled[:, :-1] / np.maximum(pooled[:, -1:], 1)
        if not network.languages:
            means = np.zeros((len(means), 1))
        best = means.argmax(axis=1)
        names = [network.languages[b] if k else UNKNOWN for b, k in zip(best, lettered)]
        score = np.where(lettered, means[np.arange(len(best)), best], 0.0).clip(0, 1)
        kept = batch.schema.names[:-2]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(names, pa.string()), pa.array(score, pa.float64())], names=[*kept, "lang_pred", "score"]
        )


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_words(docs: DataFrame, sample_docs: int, excerpt: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """(language, excerpt) of at most `sample_docs` documents per language, the same for the same rows."""
    key = row_hash(id_col, text_col)
    rows = docs.where(
        F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    ).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), unit_interval(key).alias("u"), F.xxhash64(key).alias("v"))
    # one entry per language, as in the network itself
    counts = {r["lang"]: r["many"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("many")).collect()}
    if not counts:
        return []
    many = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("lang")]
    near = rows.where(F.col("u") * many < 2 * sample_docs + 50)
    place = (unit_interval(F.col("v")) * F.greatest(F.length("text") - excerpt, F.lit(0))).cast("int") + 1
    near = near.select("lang", "u", "v", F.substring("text", place, F.lit(excerpt)).alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("u", "v", "text"))
    picked = near.withColumn("nth", nth).where(F.col("nth") <= sample_docs)
    return sorted((r["lang"], r["text"]) for r in picked.select("lang", "text").collect())


def fit(docs: DataFrame, sample_docs: int = 300, excerpt: int = 2000, steps: int = STEPS, id_col="doc_id", text_col="text", lang_col="lang") -> ByteNetwork:
    sample = training_words(docs, sample_docs, excerpt, id_col, text_col, lang_col)
    network = ByteNetwork(sorted({lang for lang, _ in sample}))
    place = {lang: i for i, lang in enumerate(network.languages)}
    words, labels = [], []
    for lang, text in sample:
        for word in text.encode().split():
            pieces = framed(word)
            words += pieces
            labels += [place[lang]] * len(pieces)
    if len(network.languages) > 1 and words:
        network.train(words, np.array(labels), steps)
        network.least_score = rejection_level(network, sample)
    return network


def rejection_level(network: ByteNetwork, sample: list[tuple[str, str]]) -> float:
    """A quarter of the way from chance to the scores of documents whose language is found."""
    known = WordScores(network)
    rows = [[known[w] for w in text.encode().split()] for _, text in sample]
    sums = known.settle()
    means = np.array([sums[r, :-1].sum(axis=0) / sums[r, -1].sum() for r in rows])
    found = means.argmax(axis=1) == [network.languages.index(lang) for lang, _ in sample]
    chance = 1 / len(network.languages)
    return float(chance + (np.quantile(means[found].max(axis=1), 0.01) - chance) / 4) if found.any() else chance


def predict(docs: DataFrame, network: ByteNetwork, columns: list[str], text_col: str = "text") -> DataFrame:
    """`columns` of every row with `lang_pred` and `score`."""
    text = F.col(text_col)
    known = F.lit(bool(network.languages))
    lettered = F.lit(bool(network.languages)) & F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*columns, text.cast("binary").alias("_bytes"), lettered.alias("_lettered"))
    schema = T.StructType(rows.schema.fields[:-2]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(lambda it: labelled(it, network), schema)


def recognised(docs: DataFrame, network: ByteNetwork, least_score: float | None = None, text_col: str = "text") -> DataFrame:
    """The documents, with all columns, in which a language is recognised: a letter, and a score above chance, or of `least_score`."""
    least_score = network.least_score if least_score is None else least_score
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    found = predict(rows, network, ["_row"], "_text")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("_row.*")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **training) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score` of every document, learned from those that are not held out."""
    network = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **training)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("_text"))
    return predict(rows, network, ["doc_id", "held_out"], "_text")
