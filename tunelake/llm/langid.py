"""Language identification by a linear-chain conditional random field.

The words of a text form a chain. A word's evidence for each label is the sum of
the weights of its affixes, character n-grams and whole form (the lexicon), hashed
into a table; labels of neighbouring words are tied by learned transitions, so a
passage in another language inside a text is labelled as such. Forward-backward
gives every word's label probabilities; a text's language is the label with the
largest mean probability, which is its score. Its ``certainty`` is the mean of its words'
largest probabilities: high also for a text that mixes languages, low where no
known language explains the words.

Training uses a bounded sample: at most ``per_label`` documents of each label (those
least by a hash of the row) and a passage of at most ``passage`` characters of
each, at a hashed place. Rows far from the least hashes are filtered out where they are read, so
no task ranks all rows of a label. Chains are spliced from passages of different labels,
so transitions are learned from switches. The table of weights (one
column a label, 2^18 rows, fewer with over 64 labels: at most 2^24 numbers) is broadcast; prediction is one
pass over whole texts, in batches whose memory does not grow with the labels. At most ``max_labels``
labels, the commonest, can be learned (a bound of the sample and the table).

Cases: a null text or one without a letter is ``und`` with score 0, and so is
every text if nothing can be learned; ties go to the label first in text order; runs of
over 32 letters are cut into words of 32; repeated rows are predicted each; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import mix64, reach_workers, slices

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]{1,32}")
_WIDE = 32
_CHUNK = 64          # words per row of the chain scan
_BATCH_CHARS = 1 << 19
_FEW = 16            # labels whose chains are scanned by transfer matrices


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray       # (2^bits, labels)
    moves: np.ndarray         # (labels, labels), from row to column


def _feature_ids(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word and a mask of those present: n-grams of two and
    three characters, prefixes and suffixes of one to three, the whole word."""
    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    wide = int(size.max(initial=1))
    flat = np.frombuffer("".join(w.ljust(wide) for w in words).encode("utf-32-le"), "<u4")
    c = np.zeros((n, wide + 2), np.uint64)
    c[:, :wide] = flat.reshape(n, wide)
    at = np.arange(wide + 2)
    c[at[None, :] >= size[:, None]] = 0
    k = np.uint64(0x9E3779B1)

    def kind(x: np.ndarray, salt: int) -> np.ndarray:
        return mix64(x * np.uint64(64) + np.uint64(salt))

    two = c[:, :wide] * k + c[:, 1:wide + 1]
    three = two * k + c[:, 2:wide + 2]
    cols = [kind(two, 1), kind(three, 2)]
    masks = [at[None, :wide] + 1 < size[:, None], at[None, :wide] + 2 < size[:, None]]
    rows = np.arange(n)
    whole = np.zeros(n, np.uint64)
    for j in range(wide):
        whole = np.where(size > j, whole * k + c[:, j], whole)
    affixes = [kind(whole, 3)]
    head, tail = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for j in range(3):
        head = head * k + c[rows, j]
        tail = tail * k + c[rows, np.maximum(size - 1 - j, 0)]
        affixes += [kind(head, 4 + j), kind(tail, 8 + j)]
    cols.append(np.stack(affixes, 1))
    masks.append(np.ones((n, len(affixes)), bool))
    ids = np.concatenate(cols, 1) & np.uint64((1 << bits) - 1)
    return ids.astype(np.int64), np.concatenate(masks, 1)


def _evidence(words: list[str], weights: np.ndarray) -> np.ndarray:
    """(words, labels) scores; a spare last row of zeros stands for absent features."""
    bits = (len(weights) - 1).bit_length()
    padded = np.vstack([weights, np.zeros((1, weights.shape[1]), weights.dtype)])
    out = np.empty((len(words), weights.shape[1]), np.float64)
    for lo in range(0, len(words), 8192):
        ids, there = _feature_ids(words[lo:lo + 8192], bits)
        ids[~there] = len(weights)
        out[lo:lo + 8192] = padded[ids].sum(1)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def _marginals(scores: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of chains of ``counts`` words.

    Chains are cut into rows of ``_CHUNK`` words. A row's transfer matrix carries the
    forward and backward vectors from row to row, then all rows are filled in at
    once, so time does not depend on one chain's length alone.
    """
    labels = scores.shape[1]
    pot = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(moves - moves.max())
    if labels > _FEW:
        return _marginals_by_word(pot, counts, step)
    n_rows = -(-counts // _CHUNK)
    first = np.cumsum(n_rows) - n_rows
    chain = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(scores)) - np.repeat(np.cumsum(counts) - counts, counts)
    row, col = first[chain] + place // _CHUNK, place % _CHUNK
    total = int(n_rows.sum())
    grid = np.zeros((total, _CHUNK, labels))
    grid[row, col] = pot
    there = np.zeros((total, _CHUNK), bool)
    there[row, col] = True

    carry = np.tile(np.eye(labels), (total, 1, 1))
    for t in range(_CHUNK):
        nxt = (carry @ step) * grid[:, t, None, :]
        nxt /= np.maximum(nxt.sum((1, 2), keepdims=True), 1e-300)
        carry = np.where(there[:, t, None, None], nxt, carry)
    fore, back = np.full((total, labels), 1 / labels), np.full((total, labels), 1 / labels)
    for q in range(1, int(n_rows.max(initial=0))):
        at = first[n_rows > q] + q
        fore[at] = _unit(np.einsum("rl,rlm->rm", fore[at - 1], carry[at - 1]))
        last = first[n_rows > q] + n_rows[n_rows > q] - 1 - q
        back[last] = _unit(np.einsum("rlm,rm->rl", carry[last + 1], back[last + 1]))
    alpha = np.empty_like(grid)
    f = fore
    for t in range(_CHUNK):
        new = _unit(np.where(there[:, t, None], (f @ step) * grid[:, t], 1.0))
        f = np.where(there[:, t, None], new, f)
        alpha[:, t] = f
    b = back
    for t in range(_CHUNK - 1, -1, -1):
        alpha[:, t] *= b
        new = _unit(np.where(there[:, t, None], (grid[:, t] * b) @ step.T, 1.0))
        b = np.where(there[:, t, None], new, b)
    return _unit(alpha[row, col])


def _marginals_by_word(pot: np.ndarray, counts: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The same for many labels: a vector a chain, from word to word, no label-by-label matrix a row."""
    start, order = np.cumsum(counts) - counts, np.argsort(-counts, kind="stable")
    longest, live = counts[order], len(counts)
    alpha = np.empty_like(pot)
    f = np.full((live, pot.shape[1]), 1 / pot.shape[1])
    lives = []
    for t in range(int(longest[0]) if live else 0):
        while longest[live - 1] <= t:
            live -= 1
        lives.append(live)
        at = start[order[:live]] + t
        f = alpha[at] = _unit((f[:live] @ step) * pot[at])
    b = np.empty((0, pot.shape[1]))
    for t in range(len(lives) - 1, -1, -1):
        b = np.concatenate([b, np.full((lives[t] - len(b), pot.shape[1]), 1 / pot.shape[1])])
        at = start[order[:lives[t]]] + t
        alpha[at] *= b
        b = _unit((pot[at] * b) @ step.T)
    return _unit(alpha)


def train(samples: list[tuple[str, str]], bits: int = 18, chain: int = 48, rounds: int = 6,
          rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> Model:
    """Fit on (label, passage) pairs by adaptive gradient steps on the chains'
    conditional likelihood."""
    rng = np.random.default_rng(seed)
    labels = tuple(sorted({lab for lab, _ in samples}))
    code = {lab: i for i, lab in enumerate(labels)}
    parts: list[tuple[int, list[str]]] = []
    for lab, text in samples:
        words = _WORD.findall(text.lower())
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 3 * chain // 2))
            parts.append((code[lab], words[at:at + n]))
            at += n
    order = rng.permutation(len(parts))
    words = [w for i in order for w in parts[i][1]]
    truth = np.array([parts[i][0] for i in order for _ in parts[i][1]], np.int64)
    n_chains = len(words) // chain
    size = len(labels)
    bits = min(bits, max(8, 24 - (size - 1).bit_length()))
    weights, moves = np.zeros((1 << bits, size), np.float32), np.zeros((size, size))
    if n_chains == 0 or size < 2:
        return Model(labels, weights, moves)
    words, truth = words[:n_chains * chain], truth[:n_chains * chain].reshape(n_chains, chain)
    index, forms = pd.factorize(np.array(words, object))
    index = index.reshape(n_chains, chain)
    ids, there = _feature_ids(list(forms), bits)
    grad_w, grad_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    per_step = max(1, min(256, n_chains // 8 or 1, (1 << 24) // (chain * size * size)))
    for _ in range(rounds):
        for lo in range(0, n_chains, per_step):
            pick = index[lo:lo + per_step]
            used, local = np.unique(pick, return_inverse=True)
            f_ids, f_on = ids[used], there[used]
            form_scores = np.where(f_on[..., None], weights[f_ids], 0).sum(1)
            local = local.reshape(pick.shape)
            scores = form_scores[local].astype(np.float64)
            pot = np.exp(scores - scores.max(-1, keepdims=True))
            step = np.exp(moves - moves.max())
            n, length = pick.shape
            a, b = np.empty((n, length, size)), np.empty((n, length, size))
            f = np.full((n, size), 1 / size)
            for t in range(length):
                f = a[:, t] = _unit((f @ step) * pot[:, t])
            g = np.full((n, size), 1 / size)
            for t in range(length - 1, -1, -1):
                b[:, t] = g
                g = _unit((pot[:, t] * g) @ step.T)
            gold = np.eye(size)[truth[lo:lo + per_step]]
            delta = gold - _unit(a * b)
            pair = a[:, :-1, :, None] * step * (pot[:, 1:] * b[:, 1:])[:, :, None, :]
            pair /= pair.sum((2, 3), keepdims=True)
            d_moves = (np.einsum("ntl,ntm->lm", gold[:, :-1], gold[:, 1:]) - pair.sum((0, 1))) / n
            d_form = np.zeros((len(used), size))
            np.add.at(d_form, local.ravel(), delta.reshape(-1, size))
            flat = f_ids[f_on]
            owner = np.repeat(np.arange(len(used)), f_on.sum(1))
            touched, slot = np.unique(flat, return_inverse=True)
            g_w = np.stack([np.bincount(slot, d_form[owner, j], len(touched))
                            for j in range(size)], 1) / n - decay * weights[touched]
            grad_w[touched] += g_w ** 2
            weights[touched] += (rate * g_w / np.sqrt(grad_w[touched])).astype(np.float32)
            grad_m += d_moves ** 2
            moves += rate * d_moves / np.sqrt(grad_m)
    return Model(labels, weights, moves)


def training_sample(docs: DataFrame, per_label: int = 300, passage: int = 1200,
                    max_labels: int = 256) -> list[tuple[str, str]]:
    """At most ``per_label`` passages for each of the ``max_labels`` commonest labels
    of ``docs`` (text, lang): the stated bound of what reaches the driver."""
    known = docs.filter("lang is not null and text is not null").select("lang", "text")
    common = (known.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct(
        F.xxhash64("text"), 0.02).alias("texts")).orderBy(F.desc("count"), "lang").limit(max_labels))
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - passage + 1, F.lit(1)))
    place = F.xxhash64("text", F.lit(3))
    # the least per_label hashes of different texts lie, but for a chance below 1e-9, among the least 2 * per_label + 200 expected
    part = F.pmod(place, F.lit(1 << 40)) * F.col("texts") <= F.lit((1 << 40) * (2.0 * per_label + 200))
    order = Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(1 << 40)), "piece")
    rows = (known.join(F.broadcast(common), "lang").filter(part)
            .select("lang", F.substring("text", (at + 1).cast("int"), F.lit(passage)).alias("piece"),
                    place.alias("place")).distinct()
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_label)
            .select("lang", "piece").orderBy("lang", "piece").collect())
    return [(r.lang, r.piece) for r in rows]


def detector(docs: DataFrame, model: Model):
    """A pandas function text -> (lang_pred, score, certainty) with ``model`` broadcast."""
    reach_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for series in batches:
            texts = [t if isinstance(t, str) else "" for t in series]
            out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
            most = _BATCH_CHARS * min(_FEW, len(m.labels)) // max(1, len(m.labels))
            for lo, hi in slices([len(t) for t in texts], most) if m.labels else ():
                found = [_WORD.findall(t.lower()) for t in texts[lo:hi]]
                use = [i for i, ws in enumerate(found) if any(w.isalpha() or any(map(str.isalpha, w))
                                                              for w in ws)]
                if not use:
                    continue
                counts = np.array([len(found[i]) for i in use], np.int64)
                index, forms = pd.factorize(np.array([w for i in use for w in found[i]], object))
                p = _marginals(_evidence(list(forms), m.weights)[index], counts, m.moves)
                first = np.cumsum(counts) - counts
                mean = np.add.reduceat(p, first) / counts[:, None]
                sure = np.add.reduceat(p.max(1), first) / counts
                for i, best, score, c in zip(use, mean.argmax(1), mean.max(1), sure):
                    out[lo + i] = (m.labels[best], min(float(score), 1.0), min(float(c), 1.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "certainty"])

    return F.pandas_udf(detect, "lang_pred string, score double, certainty double")


def is_held_out() -> Column:
    """The third of the documents (crc32 of the id) that training never sees."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, per_label: int = 300, passage: int = 1200) -> DataFrame:
    """``docs`` (doc_id, text, lang and others) with a struct column ``language``
    (lang_pred, score, certainty), learned from its rows that are not held out."""
    seen = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    model = train(training_sample(seen, per_label, passage))
    return docs.withColumn("language", detector(docs, model)(F.col("text").cast("string")))
