"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

The kernel compares windows of one word or of two neighbouring words by their common subsequences of three letters,
spread over at most ``SPAN`` letters, each occurrence weighted by ``DECAY`` per letter skipped. A space is a letter that
can be skipped like any other, and opens and ends every window. Gaps and inserted characters cost only decay, signs inside a
word nothing (they are dropped), digits and marks that look like letters are read as these, an accent is a letter of its
own before the plain one, and single letters in a row are one word.

Training takes sentences of labelled documents as bags of windows: windows that only toxic sentences have, far beyond
chance, are positive at first, windows of clean sentences negative (a pair of words counts only where neither word is
positive by itself: a phrase). Positive words written as two are positive examples too. In further rounds words of toxic sentences that the machine itself accepts join the
positives, and clean windows that it nearly accepts the negatives. The machine is linear in the landmarks' kernel
values, and since the kernel is a sum over subsequences it collapses into one weight per subsequence: scoring costs a
table look-up per subsequence, however many landmarks there are.

A document's score is a logistic function of the sum of its accepted margins, taken absolutely and per word, and of its worst
window. Syllables of an insult stand in innocent words of some languages by chance, so one doubtful window in a long text says
little, several say much. The logistic function is fitted on margins of machines that did not see the document: the
sample is dealt into ``FOLDS`` parts by text, and a machine is fitted without each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import SLICE_BYTES, give_back, keyed, mixed, slices, small_batches, stored, text_buffer, whole

DECAY, SPAN = 0.7, 5
STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
SPACE, ACCENT, WIDTH = 0, 30, 32
FEATURES = WIDTH**3
# bounds of what the classifier is fitted on; documents, sentences and pairs of words are chosen by hash
TOXIC_DOCS, CLEAN_DOCS = 4_000, 12_000
TOXIC_SENTENCES, CLEAN_SENTENCES = 40_000, 120_000
SENTENCE = r"[^.!?\n]{1,400}"
CLEAN_PAIRS, SPLIT_TRUST = 40_000, 0.05
LANDMARKS, NEGATIVES, ROUNDS = 256, 12_000, 4
FOLDS = 4
# evidence that a window is toxic: log of the odds against chance
EVIDENCE = 12.0


def letter_codes() -> np.ndarray:
    """Code of each byte: 1-26 letters, accented Latin-1 letters (their second byte) as their base, their first byte as
    the accent, look-alikes as the letter meant, 27-30 other scripts, 0 dropped."""
    table = np.zeros(256, np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    for sign, letter in {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}.items():
        table[ord(sign)] = table[ord(letter)]
    # U+00C0-U+00FF in order, small letters after capital ones
    for i, letter in enumerate("aaaaaaaceeeeiiiidnooooo ouuuuyts"):
        if letter != " ":
            table[0x80 + i] = table[0xA0 + i] = table[ord(letter)]
    table[0xC3] = ACCENT
    for b in range(0xC4, 0xF8):
        table[b] = 27 + b % 4
    return table


CODES = letter_codes()
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Coded:
    """Windows of a batch as codes: each has ``size`` codes from ``begin``, the first and last of them spaces. In a text,
    a word's last space is the next word's first."""

    codes: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    row: np.ndarray

    def steps(self) -> np.ndarray:
        """Codes from the begin of a window to that of the next."""
        return np.diff(np.append(self.begin, len(self.codes)))

    def left(self) -> np.ndarray:
        """Codes from each place to the end of the window that begins last before it."""
        return np.repeat(self.begin + self.size, self.steps()) - np.arange(len(self.codes))


def coded(raw: np.ndarray, rows: np.ndarray) -> Coded:
    n_rows = len(rows) - 1
    row_of = np.repeat(np.arange(n_rows), np.diff(rows))
    code, space = CODES[raw], SPACES[raw]
    # number of the word a byte is in: spaces and row starts begin new ones
    word = np.cumsum(space) + row_of
    keep = np.flatnonzero((code > 0) & ~space)
    code, word, row = code[keep], word[keep], row_of[keep]
    if not len(code):
        empty = np.empty(0, np.int64)
        return Coded(np.empty(0, np.int64), empty, empty, empty)
    first = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
    size, row = np.diff(np.append(first, len(code))), row[first]
    # single letters in a row are one word
    go_on = np.zeros(len(first), bool)
    go_on[1:] = (size[1:] == 1) & (size[:-1] == 1) & (row[1:] == row[:-1])
    first, row = first[~go_on], row[~go_on]
    begin = first + np.arange(len(first))
    out = np.full(len(code) + len(first) + 1, SPACE, np.int64)
    inside = np.ones(len(out), bool)
    inside[begin] = inside[-1] = False
    out[inside] = code
    return Coded(out, begin, np.diff(np.append(begin, len(out) - 1)) + 1, row)


def pairs(words: Coded) -> tuple[Coded, np.ndarray]:
    """Windows of two neighbouring words of a row, and the number of the first word of each."""
    i = np.flatnonzero(words.row[1:] == words.row[:-1])
    return Coded(words.codes, words.begin[i], words.size[i] + words.size[i + 1] - 1, words.row[i]), i


def spelled(c: np.ndarray, at: np.ndarray, a: int, b: int) -> np.ndarray:
    return (c[at] * WIDTH + c[at + a]) * WIDTH + c[at + b]


def subsequences(words: Coded) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way to skip letters: where a subsequence starts, which it is, and its weight."""
    left = words.left()
    for a, b in STEPS:
        at = np.flatnonzero(left > b)
        yield at, spelled(words.codes, at, a, b), DECAY ** (b - 2)


def own_size(size: np.ndarray) -> np.ndarray:
    """Square root of a window's kernel with itself, had it no subsequence twice."""
    total = sum(DECAY ** (2 * (b - 2)) * np.maximum(size - b, 0) for _, b in STEPS)
    return np.sqrt(np.maximum(total, DECAY**8))


def sums(words: Coded, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words.codes))
    for at, which, weight in subsequences(words):
        total[at] += weight * weights[which]
    return np.add.reduceat(total, words.begin)


def margins(words: Coded, weights: np.ndarray, bias: float) -> np.ndarray:
    if not len(words.begin):
        return np.empty(0)
    return sums(words, weights) / own_size(words.size) + bias


def text_margins(words: Coded, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Margins of the words of texts, of their pairs of neighbours, and the first word of each pair. A pair's sum is
    that of its words and of the subsequences from one into the other."""
    if not len(words.begin):
        return np.empty(0), np.empty(0), np.empty(0, np.int64)
    own = sums(words, weights)
    both, first = pairs(words)
    reach = np.zeros(len(words.begin), np.int64)
    reach[first] = words.size[first + 1] - 1
    left, reach = words.left(), np.repeat(reach, words.steps())
    total = np.zeros(len(words.codes))
    for a, b in STEPS:
        at = np.flatnonzero((left <= b) & (left + reach > b))
        total[at] += DECAY ** (b - 2) * weights[spelled(words.codes, at, a, b)]
    across = np.add.reduceat(total, words.begin)
    return (
        own / own_size(words.size) + bias,
        (own[first] + own[first + 1] + across[first]) / own_size(both.size) + bias,
        first,
    )


def feature_rows(words: Coded, table: np.ndarray) -> np.ndarray:
    """Kernel values of each window with the landmarks whose feature vectors are the columns of ``table``: place by place
    of all windows that are long enough."""
    order = np.argsort(-words.size, kind="stable")
    begin, size = words.begin[order], words.size[order]
    out = np.zeros((len(begin), table.shape[1]), np.float32)
    for a, b in STEPS:
        for j in range(int(size[0]) - b):
            n = int(np.searchsorted(-size, -(j + b)))
            for lo in range(0, n, 20_000):
                at = begin[lo : min(lo + 20_000, n)] + j
                out[lo : lo + len(at)] += table[spelled(words.codes, at, a, b)] * np.float32(DECAY ** (b - 2))
    back = np.empty_like(out)
    back[order] = out / own_size(size)[:, None].astype(np.float32)
    return back


def feature_table(words: Coded) -> np.ndarray:
    """Feature vectors of landmarks, as columns."""
    out = np.zeros((FEATURES, len(words.begin)), np.float32)
    word = np.repeat(np.arange(len(words.begin)), words.steps())
    for at, which, weight in subsequences(words):
        np.add.at(out, (which, word[at]), np.float32(weight))
    return out / own_size(words.size).astype(np.float32)


def chosen(words: Coded, which: np.ndarray) -> Coded:
    size = words.size[which]
    begin = np.cumsum(size) - size
    at = np.repeat(words.begin[which] - begin, size) + np.arange(size.sum())
    return Coded(words.codes[at], begin, size, words.row[which])


def names(words: Coded) -> np.ndarray:
    """A 64-bit name for each window, equal for equal codes."""
    apart = chosen(words, np.arange(len(words.begin)))
    up = np.uint64(0x9E3779B97F4A7C15) ** np.arange(int(apart.size.max()), dtype=np.uint64)
    place = np.arange(len(apart.codes)) - np.repeat(apart.begin, apart.size)
    return mixed(np.add.reduceat((apart.codes.astype(np.uint64) + np.uint64(1)) * up[place], apart.begin))


def joined(parts: list[Coded]) -> Coded:
    shift = np.cumsum([0] + [len(p.codes) for p in parts])
    return Coded(*(np.concatenate(x) for x in zip(*[(p.codes, p.begin + d, p.size, p.row) for p, d in zip(parts, shift)])))


def batches_of(sentences: pa.Array, toxic: np.ndarray, at_once: int = 5_000) -> Iterator[tuple[Coded, np.ndarray]]:
    """Words of a few sentences at a time, with the sentences' labels."""
    for at in range(0, len(sentences), at_once):
        words = coded(*text_buffer(sentences.slice(at, at_once)))
        if len(words.begin):
            yield words, toxic[at : at + at_once]


def sentence_counts(name: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names and in how many toxic and clean sentences they are."""
    order = np.lexsort((row, name))
    name, row = name[order], row[order]
    new = np.flatnonzero((np.diff(name, prepend=~name[:1]) != 0) | (np.diff(row, prepend=-1) != 0))
    name, bad = name[new], toxic[row[new]]
    edge = np.flatnonzero(np.diff(name, prepend=~name[:1]) != 0)
    n_toxic = np.add.reduceat(bad.astype(np.int64), edge)
    return name[edge], n_toxic, np.diff(np.append(edge, len(name))) - n_toxic


def added(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return found, *(np.bincount(of, weights=np.concatenate([p[k] for p in parts])).astype(np.int64) for k in (1, 2))


def word_types(sentences: pa.Array, toxic: np.ndarray) -> tuple[Coded, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their names, and the number of toxic and of clean sentences that have them."""
    parts, counts = [], []
    for words, bad in batches_of(sentences, toxic):
        name = names(words)
        counts.append(sentence_counts(name, words.row, bad))
        parts.append(chosen(words, np.unique(name, return_index=True)[1]))
    if not parts:
        empty = np.empty(0, np.int64)
        return Coded(empty, empty, empty, empty), empty, empty, empty
    example = np.unique(np.concatenate([c[0] for c in counts]), return_index=True)[1]
    return chosen(joined(parts), example), *added(counts)


def phrase_types(
    sentences: pa.Array, toxic: np.ndarray, insults: np.ndarray
) -> tuple[Coded, np.ndarray, np.ndarray, np.ndarray] | None:
    """Distinct pairs of words, neither of them among ``insults``, with the number of toxic and of clean sentences that
    have them: those with evidence of being toxic, and ``CLEAN_PAIRS`` of those that clean sentences have, by name; and the
    names of all pairs in clean sentences."""

    def without_insults() -> Iterator[tuple[Coded, np.ndarray, np.ndarray]]:
        for words, bad in batches_of(sentences, toxic):
            both, first = pairs(words)
            insult = np.isin(names(words), insults)
            fine = np.flatnonzero(~insult[first] & ~insult[first + 1])
            if len(fine):
                both = chosen(both, fine)
                yield both, names(both), bad

    counts = [sentence_counts(name, both.row, bad) for both, name, bad in without_insults()]
    if not counts:
        return None
    found, n_toxic, n_clean = added(counts)
    rate, weight = evidence(n_toxic, n_clean, toxic.mean())
    in_clean = found[n_clean > 0]
    wanted = (rate > toxic.mean()) & (weight > EVIDENCE)
    wanted[np.flatnonzero((n_clean > 0) & ~wanted)[:CLEAN_PAIRS]] = True  # names are hashes in order
    found, n_toxic, n_clean = found[wanted], n_toxic[wanted], n_clean[wanted]
    parts, seen = [], []
    for both, name, _ in without_insults():
        one, example = np.unique(name, return_index=True)
        keep = np.isin(one, found)
        parts.append(chosen(both, example[keep]))
        seen.append(one[keep])
    example = np.unique(np.concatenate(seen), return_index=True)[1]
    return chosen(joined(parts), example), n_toxic, n_clean, in_clean


def split_windows(words: Coded) -> Coded:
    """Each word cut in two at every place that leaves two letters on either side; ``row`` is the word it comes from."""
    parts, rows = [], []
    for i, (begin, size) in enumerate(zip(words.begin.tolist(), words.size.tolist())):
        code = words.codes[begin : begin + size]
        for cut in range(3, size - 2):
            parts.append(np.insert(code, cut, SPACE))
            rows.append(i)
    size = np.array([len(p) for p in parts], np.int64)
    return Coded(np.concatenate([*parts, np.empty(0, np.int64)]), np.cumsum(size) - size, size, np.array(rows, np.int64))


def evidence(n_toxic: np.ndarray, n_clean: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Share of toxic ones among the sentences of each window, and the log of the odds of that against chance."""
    rate = np.clip(n_toxic / (n_toxic + n_clean), 1e-9, 1 - 1e-9)
    return rate, n_toxic * np.log(rate / share) + n_clean * np.log((1 - rate) / (1 - share))


@dataclass
class Model:
    """Weights per subsequence and bias of the margin of a window; without labels of both kinds it accepts nothing."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = -1.0


def fit_windows(sentences: pa.Array, toxic: np.ndarray) -> Model:
    """The machine from labelled sentences; without sentences of both kinds it accepts nothing."""
    if not toxic.any() or toxic.all():
        return Model()
    share = toxic.mean()
    types, name, n_toxic, n_clean = word_types(sentences, toxic)
    if not len(types.begin):
        return Model()
    rate, weight = evidence(n_toxic, n_clean, share)
    positive = (types.size > 4) & (rate > share) & (weight > EVIDENCE)
    phrases = phrase_types(sentences, toxic, name[positive])
    if phrases is not None:
        types, n_toxic, n_clean = joined([types, phrases[0]]), np.append(n_toxic, phrases[1]), np.append(n_clean, phrases[2])
        rate, weight = evidence(n_toxic, n_clean, share)
    usable = types.size > 4
    positive = usable & (rate > share) & (weight > EVIDENCE)
    trust = np.maximum(weight, 4.0)
    if not positive.any():
        best = np.where(usable & (n_clean == 0), weight, 0)
        positive = (best > 0) & (best >= 0.7 * best.max())
        if not positive.any():
            return Model()
    clean = np.flatnonzero(usable & (n_clean > 0) & ~positive)
    clean = clean[np.argsort(-n_clean[clean], kind="stable")]
    rng = np.random.default_rng(7)
    negative = np.unique(np.concatenate([clean[: NEGATIVES // 2], rng.permutation(clean)[: NEGATIVES // 2]]))
    doubtful = usable & (n_clean == 0)
    # insults written as two words are examples too, unless clean sentences have that pair
    sure = np.flatnonzero(positive[: len(name)])
    sure = sure[np.argsort(-weight[sure], kind="stable")][:LANDMARKS]
    cuts = split_windows(chosen(types, sure))
    if len(cuts.begin) and phrases is not None:
        cuts = chosen(cuts, np.flatnonzero(~np.isin(names(cuts), phrases[3])))
    if len(cuts.begin):
        of, extra = sure[cuts.row], np.ones(len(cuts.begin), bool)
        types, positive, doubtful = joined([types, cuts]), np.append(positive, extra), np.append(doubtful, ~extra)
        trust = np.append(trust, SPLIT_TRUST * trust[of] / np.bincount(of)[of])
    by_trust = np.append(weight, np.zeros(len(cuts.begin)))  # landmarks are windows that were seen
    model = Model()
    for _ in range(ROUNDS):
        good = np.flatnonzero(positive)
        half = LANDMARKS // 2
        marks = np.concatenate([good[np.argsort(-by_trust[good], kind="stable")][:half], rng.permutation(negative)[:half]])
        model.weights, model.bias = machine(types, marks, good, negative, trust[good])
        found = [margins(chosen(types, part), model.weights, model.bias) for part in np.array_split(np.arange(len(types.begin)), 1 + len(types.begin) // 20_000)]
        found = np.concatenate(found)
        positive |= doubtful & (found > 0.3)
        hard = clean[np.argsort(-found[clean], kind="stable")][: NEGATIVES // 2]
        negative = np.unique(np.concatenate([negative, hard[found[hard] > -0.9]]))
    return model


def machine(types: Coded, marks: np.ndarray, good: np.ndarray, bad: np.ndarray, trust: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared-hinge machine in the Nyström space of the landmarks, as weights per subsequence."""
    table = feature_table(chosen(types, marks))
    gram = (table.T @ table).astype(np.float64)
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-3 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # kernel values -> Nyström coordinates
    x = feature_rows(chosen(types, np.concatenate([good, bad])), table) @ root.astype(np.float32)
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    y = np.concatenate([np.ones(len(good)), -np.ones(len(bad))])
    weight = np.concatenate([trust / trust.sum(), np.full(len(bad), 1 / len(bad))]) * 2_000
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3
    for _ in range(12):  # Newton steps on the words within the margin
        inside = np.flatnonzero(y * (x @ w) < 1)
        xi = x[inside]
        gram = (xi.T * weight[inside].astype(np.float32)) @ xi + np.diag(ridge)
        new = np.linalg.solve(gram, xi.T @ (weight[inside] * y[inside]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return (table @ (root @ w[:-1])).astype(np.float64), float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_labels(labels: DataFrame, id_col: str, toxic_col: str) -> DataFrame:
    """``doc_id, toxic`` of the rows to learn from: all but those whose crc32 of the id as text is 2 modulo 4."""
    doc_id = F.col(f"`{id_col}`").cast("long")
    known = labels.select(doc_id.alias("doc_id"), F.col(f"`{toxic_col}`").cast("int").alias("toxic"))
    return known.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(known: DataFrame, toxic_docs: int, clean_docs: int) -> DataFrame:
    """At most so many labelled ids of each kind, by hash."""
    order = F.xxhash64("doc_id")
    return known.where("toxic = 1").orderBy(order).limit(toxic_docs).unionByName(known.where("toxic = 0").orderBy(order).limit(clean_docs))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    toxic_col: str = "toxic",
    toxic_docs: int = TOXIC_DOCS,
    clean_docs: int = CLEAN_DOCS,
) -> DataFrame:
    """One row per document: doc_id, text_key, held_out, score, predicted (score >= ``threshold``).

    The classifier is fitted on at most ``toxic_docs`` and ``clean_docs`` labelled documents, ``TOXIC_SENTENCES`` and
    ``CLEAN_SENTENCES`` of their sentences (of 4 to 400 characters) and windows of these (``LANDMARKS``, ``NEGATIVES``,
    ``CLEAN_PAIRS``); every word and pair of neighbours of every document is scored. Where a labelled id has several texts the
    smallest is learned from. Without labels of both kinds all scores are low. NULL and empty texts get the score of a
    document without words; equal texts get equal scores. A NULL id is not held out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = stored(sampled(training_labels(labels, label_id_col, toxic_col), toxic_docs, clean_docs), "labelled")
    known = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole(F.col(f"`{text_col}`")).alias("text"))
    known = known.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    known = stored(known.select("text", "toxic", fold.alias("fold"), F.xxhash64("text").alias("text_key")), "labelled-texts")
    models = fitted_models(known)
    shared = spark.sparkContext.broadcast(models)
    seen = known.mapInArrow(window_sums(shared, known.columns[1:], "fold"), f"toxic INT, fold INT, text_key LONG, {SUMS}")
    seen = seen.select("toxic", *FIGURES).toPandas()  # one line per document of the bounded sample
    line = np.array([0.0, 0.0, 0.0, -3.0])
    if seen["toxic"].nunique() == 2:
        line = logistic(np.column_stack([figures(*(seen[c].to_numpy(float) for c in FIGURES)), np.ones(len(seen))]), seen["toxic"].to_numpy(float))
    sums_of = keyed(docs, id_col, text_col).mapInArrow(window_sums(shared, ["doc_id", "text_key"]), f"doc_id LONG, text_key LONG, {SUMS}")
    sums_of = stored(sums_of, "window-sums")
    logit = sum((x * float(w) for x, w in zip(figure_columns(), line)), F.lit(float(line[-1])))
    score = 1 / (1 + F.exp(-logit))
    return sums_of.select(
        "doc_id", "text_key", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted")
    )


FIGURES = ["top", "accepted", "n_words"]
SUMS = "top DOUBLE, accepted DOUBLE, n_words LONG"


def figures(top: np.ndarray, accepted: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """What the score of a document is made of: worst margin, accepted margins, and these per word."""
    return np.column_stack([top, np.log1p(accepted), np.log((accepted + 0.5) / (n_words + 50))])


def figure_columns() -> list[Column]:
    accepted = F.col("accepted")
    return [F.col("top"), F.log1p(accepted), F.log((accepted + 0.5) / (F.col("n_words") + 50))]


def fitted_models(known: DataFrame) -> list[Model]:
    """A machine without each fold of the labelled texts, then the one of all; fitted side by side, one task each, on the
    bounded set of sentences. The driver gets the weights only."""
    sentences = known.select("toxic", "fold", F.explode(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))).alias("sentence"))
    folds = F.array_sort(F.collect_set("fold"))  # FOLDS numbers at most
    sentences = sentences.groupBy("sentence").agg(F.max("toxic").alias("toxic"), folds.alias("folds")).where("length(sentence) > 3")
    sentences = stored(sentences, "sentences")
    order = F.xxhash64("sentence")
    chosen_ones = sentences.where("toxic = 1").orderBy(order).limit(TOXIC_SENTENCES).unionByName(
        sentences.where("toxic = 0").orderBy(order).limit(CLEAN_SENTENCES)
    )
    chosen_ones = stored(chosen_ones, "chosen-sentences")
    # a sentence found in several folds is left out of each of their machines
    part = F.explode(F.expr(f"filter(sequence(0, {FOLDS}), x -> NOT array_contains(folds, x))")).alias("part")
    fits = chosen_ones.select("sentence", "toxic", part).groupBy("part").applyInArrow(fit_part, "part INT, weights BINARY, bias DOUBLE").collect()
    found = {r.part: Model(np.frombuffer(r.weights), r.bias) for r in fits}
    return [found.get(k, Model()) for k in range(FOLDS + 1)]


def fit_part(table: pa.Table) -> pa.Table:
    table = table.sort_by("sentence").combine_chunks()
    sentences = pa.concat_arrays([c.cast(pa.string()) for c in table.column("sentence").chunks])
    model = fit_windows(sentences, table.column("toxic").to_numpy() == 1)
    give_back()
    return pa.table(
        {"part": table.column("part")[:1].cast(pa.int32()), "weights": pa.array([model.weights.astype(float).tobytes()], pa.binary()), "bias": pa.array([float(model.bias)])}
    )


def window_sums(models, kept: list[str], fold: str | None = None):
    """Per document: the margin of its worst window, within -1 and 2, the sum of accepted (positive) margins, and the
    number of words. A pair counts by what its margin exceeds the accepted ones of its words. The machine is that of
    all, or the one without the row's ``fold``."""

    def of(text: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, n = coded(*text_buffer(text)), len(text)
        own, both, first = text_margins(words, model.weights, model.bias)
        own, both = np.clip(own, -1.0, 2.0), np.clip(both, -1.0, 2.0)
        top, ones = np.full(n, -1.0), np.maximum(own, 0)
        if len(own):
            worst = own.copy()
            worst[first] = np.maximum(worst[first], both)
            edge = np.flatnonzero(np.diff(words.row, prepend=-1))
            top[words.row[edge]] = np.maximum.reduceat(worst, edge)
        accepted = np.bincount(words.row, weights=ones, minlength=n)
        more = np.maximum(both - ones[first] - ones[first + 1], 0)
        return top, accepted + np.bincount(words.row[first], weights=more, minlength=n), np.bincount(words.row, minlength=n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: list[Model] = models.value
        for batch in slices(batches, "text", SLICE_BYTES):
            which = np.full(batch.num_rows, FOLDS) if fold is None else batch.column(fold).to_numpy()
            for k in np.unique(which):
                part = batch.filter(pa.array(which == k))
                top, accepted, n_words = of(part.column("text"), every[k])
                out = {c: part.column(c) for c in kept}
                out |= {"top": pa.array(top), "accepted": pa.array(accepted), "n_words": pa.array(n_words.astype(np.int64))}
                yield pa.RecordBatch.from_pydict(out)

    return run
