"""Language identification: a linear-chain conditional random field labels every word.

Emissions are sums of learned weights of a word's features: the word itself (lexicon), its affixes and
its byte n-grams. Learned transitions carry evidence along the text, so that a run of words in another
language is labelled as such. Forward-backward gives the marginals; a text's language is the label with
the largest mean marginal over all its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.llm.columns import apart, text_place
from goldenrec.llm.words import LOWER, Slice, Words, find_words, mix64, row_starts, slices

# The model is fitted on a bounded sample: so many documents of a language, so many characters of each.
SAMPLE_DOCS = 120
SAMPLE_CHARS = 2000
# Words of one chain; longer texts are several chains, all of which are labelled.
CHAIN_WORDS = 64
# Bytes of text labelled at a time, times labels: a worker takes some 130 bytes for each byte of text at four labels.
LABEL_BYTES = 1 << 20
UNKNOWN = "und"

ROUNDS = 25
RATE = 0.3
DECAY = 1e-4
# Bytes of text, and words, that the fit takes at a time where it handles single features: it runs on the driver.
FIT_BYTES = 1 << 17
FIT_WORDS = 1 << 13

# Sizes of the weight tables, as powers of two: the bigrams of bytes have a place each.
LEXICON, AFFIX, TRIGRAM = 1 << 17, 1 << 16, 1 << 16
BIGRAM = 1 << 16
AFFIX_BYTES = (1, 2, 3, 4)

_U = np.uint64
LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[0x80:] = True


class Model(NamedTuple):
    """Labels, one weight row per feature (lexicon, affixes, bigrams, trigrams), transitions, starts."""

    labels: list[str]
    weights: np.ndarray
    steps: np.ndarray
    start: np.ndarray


def _word_features(data: np.ndarray, words: Words) -> np.ndarray:
    """Lexicon and affix features, one row per word; a missing affix repeats the whole word's."""
    columns = [(words.hash >> _U(40)).astype(np.int64) % LEXICON]
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(_U)
    length = words.end - words.start
    for size in AFFIX_BYTES:
        here = np.minimum(length, size)
        head = tail = np.full(len(length), _U(size))
        for place in range(size):
            inside = place < here
            head = head * _U(257) + np.where(inside, padded[words.start + place], _U(0))
            tail = tail * _U(257) + np.where(inside, padded[np.maximum(words.end - 1 - place, 0)], _U(0))
        columns.append(LEXICON + (mix64(head) >> _U(48)).astype(np.int64) % AFFIX)
        columns.append(LEXICON + (mix64(tail ^ _U(0xF00D)) >> _U(48)).astype(np.int64) % AFFIX)
    return np.stack(columns, axis=1)


def _gram_features(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(byte, feature) of all bigrams and of all trigrams that lie within a word."""
    # number of the word that began last, which also parts words of neighbouring rows
    begins = np.zeros(len(data), np.int32)
    begins[words.start] = 1
    own = np.cumsum(begins)
    change = np.zeros(len(data) + 1, np.int8)
    change[words.start] += 1
    change[words.end] -= 1
    here = np.cumsum(change[:-1], dtype=np.int8) > 0
    two = np.flatnonzero(here[:-1] & here[1:] & (own[:-1] == own[1:]))
    three = two[:-1][(two[1:] == two[:-1] + 1) & (own[two[:-1]] == own[two[1:]])] if len(two) else two
    wide = data.astype(np.int64)
    first = LEXICON + AFFIX
    pair = first + wide[two] * 256 + wide[two + 1]
    triple = (wide[three] * 65536 + wide[three + 1] * 256 + wide[three + 2]).astype(_U)
    return two, pair, three, first + BIGRAM + (mix64(triple) >> _U(48)).astype(np.int64) % TRIGRAM


def emissions(data: np.ndarray, words: Words, weights: np.ndarray) -> np.ndarray:
    """Score of every label for every word."""
    scores = np.zeros((len(words.start), weights.shape[1]), np.float32)
    own = _word_features(data, words)
    for column in range(own.shape[1]):
        scores += weights[own[:, column]]
    for at, feature in zip(*[iter(_gram_features(data, words))] * 2, strict=True):
        sums = np.zeros((len(at) + 1, weights.shape[1]), np.float64)
        np.cumsum(weights[feature], axis=0, out=sums[1:], dtype=np.float64)
        scores += (sums[np.searchsorted(at, words.end)] - sums[np.searchsorted(at, words.start)]).astype(np.float32)
    return scores


def _normal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = x.sum(axis=1, keepdims=True)
    return x / total, total[:, 0]


def forward_backward(scores: np.ndarray, size: np.ndarray, steps: np.ndarray, start: np.ndarray):
    """Marginals (chain, place, label), expected transitions and log partition of padded chains.

    ``scores`` are (chain, place, label) log potentials, ``size`` the real length of each chain.
    """
    chains, length, labels = scores.shape
    top = scores.max(axis=2, keepdims=True)
    potential = np.exp(scores - top)
    jump = np.exp(steps)
    real = np.arange(length)[None, :] < size[:, None]
    ahead = np.zeros((chains, length, labels))
    ahead[:, 0], total = _normal(potential[:, 0] * np.exp(start))
    partition = np.log(total) + top[:, 0, 0]
    for place in range(1, length):
        found, total = _normal((ahead[:, place - 1] @ jump) * potential[:, place])
        live = real[:, place]
        ahead[:, place] = np.where(live[:, None], found, ahead[:, place - 1])
        partition += np.where(live, np.log(total) + top[:, place, 0], 0)
    back = np.ones((chains, labels))
    marginal = np.zeros((chains, length, labels))
    moved = np.zeros((labels, labels))
    for place in range(length - 1, -1, -1):
        marginal[:, place], _ = _normal(ahead[:, place] * back)
        if place:
            live = real[:, place]
            weighted = potential[:, place] * back
            pair = ahead[:, place - 1][:, :, None] * jump[None] * weighted[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            moved += pair[live].sum(axis=0)
            earlier, _ = _normal(weighted @ jump.T)
            back = np.where(live[:, None], earlier, back)
    return np.where(real[:, :, None], marginal, 0), moved, partition


def _padded(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Index of the word at each (chain, place); consecutive words fill chains of the given sizes."""
    begins = np.cumsum(size) - size
    place = np.minimum(np.arange(CHAIN_WORDS)[None, :], size[:, None] - 1)
    return words[begins[:, None] + place]


def _chains(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, size) of the chains that cut each row's words."""
    chains = -(-count // CHAIN_WORDS)
    row = np.repeat(np.arange(len(count)), chains)
    number = np.arange(len(row)) - np.repeat(np.cumsum(chains) - chains, chains)
    return row, np.minimum(count[row] - number * CHAIN_WORDS, CHAIN_WORDS)


def _by_word(begins: np.ndarray, features: int) -> Iterator[tuple[slice, slice]]:
    """Ranges of FIT_WORDS words with the ranges of their features."""
    for first in range(0, len(begins), FIT_WORDS):
        last = min(first + FIT_WORDS, len(begins))
        yield slice(first, last), slice(begins[first], begins[last] if last < len(begins) else features)


def fit(texts: list[str], langs: list[str]) -> Model | None:
    """Model from labelled texts; None without any word.

    One half of the chains are stretches of a text, the other half mixes short runs of words of all
    texts, as code-switched writing does; both teach the transitions.
    """
    labels = sorted(set(langs))
    column = pa.array(texts, pa.string())
    random = np.random.default_rng(7)
    ids, counts, target = [], [], []
    runs: list[np.ndarray] = []
    total = 0
    for part in slices(column, FIT_BYTES):
        words = find_words(part, LETTERS, LOWER)
        data = LOWER[part.data]
        own = _word_features(data, words)
        at2, f2, at3, f3 = _gram_features(data, words)
        each = np.concatenate([np.repeat(np.arange(len(own)), own.shape[1]), *(
            np.searchsorted(words.start, at, "right") - 1 for at in (at2, at3)
        )])
        order = np.argsort(each, kind="stable")
        ids.append(np.concatenate([own.reshape(-1), f2, f3])[order].astype(np.int32))
        counts.append(np.bincount(each, minlength=len(own)))
        target.append(np.array([labels.index(langs[part.first + row]) for row in words.row], np.int64))
        starts = row_starts(words)
        for row in range(part.rows):
            begin = starts[row]
            while begin < starts[row + 1]:
                end = min(begin + int(random.integers(4, 24)), starts[row + 1])
                runs.append(np.arange(begin, end) + total)
                begin = end
        total += len(own)
    if not total:
        return None
    ids, counts, target = np.concatenate(ids), np.concatenate(counts), np.concatenate(target)
    straight = np.arange(total)
    mixed = np.concatenate([runs[i] for i in random.permutation(len(runs))])
    sequence = np.concatenate([straight, mixed])
    _, size = _chains(np.array([total, total]))
    grid = _padded(sequence, size)
    real = np.arange(CHAIN_WORDS)[None, :] < size[:, None]
    gold = target[grid]
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    wide = len(labels)
    weights = np.zeros((LEXICON + AFFIX + BIGRAM + TRIGRAM, wide), np.float32)
    steps, start = np.zeros((wide, wide)), np.zeros(wide)
    truth_steps = np.zeros((wide, wide))
    both = real[:, 1:]
    np.add.at(truth_steps, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    truth_start = np.bincount(gold[:, 0], minlength=wide)
    uses = np.bincount(grid[real], minlength=total).astype(float)
    truth = np.zeros((total, wide))
    truth[np.arange(total), target] = uses
    used = np.zeros(len(weights), bool)
    used[ids] = True
    known = np.flatnonzero(used)
    place_of = (np.cumsum(used) - 1)[ids]
    del ids
    active = np.zeros((len(known), wide))
    slope_sums = [np.full(active.shape, 1e-8), np.full(steps.shape, 1e-8), np.full(start.shape, 1e-8)]
    for _ in range(ROUNDS):
        scores = np.empty((total, wide))
        for own, features in _by_word(begins, len(place_of)):
            np.add.reduceat(active[place_of[features]], begins[own] - features.start, axis=0, out=scores[own])
        marginal, moved, _ = forward_backward(scores[grid], size, steps, start)
        expected = np.zeros((total, wide))
        for label in range(wide):
            expected[:, label] = np.bincount(grid[real], marginal[:, :, label][real], minlength=total)
        slope = truth - expected
        by_feature = np.stack(
            [np.bincount(place_of, np.repeat(slope[:, label], counts), len(known)) for label in range(wide)], axis=1
        )
        slopes = [
            by_feature - DECAY * total * active,
            truth_steps - moved - DECAY * total * steps,
            truth_start - marginal[:, 0].sum(axis=0) - DECAY * total * start,
        ]
        for value, slope, squares in zip((active, steps, start), slopes, slope_sums, strict=True):
            squares += slope**2
            value += RATE * slope / np.sqrt(squares)
    weights[known] = active
    return Model(labels, weights, steps, start)


def label_shares(part: Slice, model: Model) -> np.ndarray:
    """Mean marginal of every label over the words of each row (zero without words)."""
    words = find_words(part, LETTERS, LOWER)
    shares = np.zeros((part.rows, len(model.labels)))
    if not len(words.start):
        return shares
    scores = emissions(LOWER[part.data], words, model.weights)
    row, size = _chains(words.count)
    grid = _padded(np.arange(len(words.start)), size)
    # chains of all rows side by side; equal work for a long text and for many short ones
    for first in range(0, len(row), 2048):
        here = slice(first, first + 2048)
        marginal, _, _ = forward_backward(scores[grid[here]], size[here], model.steps, model.start)
        np.add.at(shares, row[here], marginal.sum(axis=1))
    return shares / np.maximum(words.count, 1)[:, None]


def _predict(shared, names: list[str]) -> Callable:
    """Task function: the last column is ``lettered``; the others, the text among them, pass through."""
    text = text_place(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        wide = len(model.labels) if model else 1
        for batch in batches:
            for part in slices(batch.column(text), LABEL_BYTES // max(wide, 4)):
                own = batch.slice(part.first, part.rows)
                lettered = np.asarray(own.column(own.num_columns - 1))
                best, score = np.full(part.rows, UNKNOWN, object), np.zeros(part.rows)
                if model:
                    shares = label_shares(part, model)
                    top = shares.argmax(axis=1)
                    best = np.where(lettered, np.array(model.labels, object)[top], UNKNOWN)
                    score = np.where(lettered, np.clip(shares[np.arange(part.rows), top], 0.0, 1.0), 0.0)
                found = [pa.array(best, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], *found], [*names, "lang_pred", "score"])

    return run


def held_out() -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> Model | None:
    """Model of the languages in ``docs(doc_id, text, lang)``, from at most SAMPLE_DOCS documents of each."""
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.where(F.col("text").isNotNull())
        .select("doc_id", "lang")
        .withColumn("turn", F.row_number().over(order))
        .where(F.col("turn") <= SAMPLE_DOCS)
        .select("doc_id")
        .distinct()
    )
    rows = (
        known.join(chosen, "doc_id", "left_semi")
        .groupBy("doc_id", "lang")
        .agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
        .where("text is not null")
        .orderBy("lang", "doc_id")
        .collect()
    )
    return fit([row.text for row in rows], [row.lang for row in rows]) if rows else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``held_out, lang_pred, score``, in one pass and without a shuffle.

    NULL text, or one without any letter: ``und`` with score 0, as everything is without a model. The
    score is the mean marginal of the label over all words. NULL doc_id: not held out, not learned
    from. Repeated rows are labelled each. Other columns pass through; input columns with one of the
    three names are replaced.
    """
    docs, restored = apart(docs.drop("held_out", "lang_pred", "score"), ("_lettered",))
    kept = docs.withColumn("held_out", held_out())
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    source = kept.select("*", lettered.alias("_lettered"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*kept.schema.fields, *found])
    return restored(source.mapInArrow(_predict(shared, kept.columns), schema))
