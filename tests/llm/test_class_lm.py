"""Class-based language model against versions by hand."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edge_tables import SF0001, edge_docs, empty_docs  # noqa: F401
from heartspark.llm import class_lm as lm
from heartspark.llm import queries

END = lm.END


def tokens_of(text):
    raw = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
    return [w.strip() for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)] + [END]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def base_by_hand(docs):
    train = Counter(w for i, t in docs if not is_held(i) for w in tokens_of(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in docs:
        said = tokens_of(t)
        out.append((i, is_held(i), len(said), sum(train[w] > 0 for w in said), n, sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in said)))
    return train, sorted(out, key=str)


def check_base(df, docs):
    rows = df.collect()
    train, want = base_by_hand(docs)
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows], key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    assert all(r.score < 0 and math.isclose(math.log10(r.perplexity), -r.score / r.n_tokens, rel_tol=1e-9) for r in rows)
    return train, rows


def test_gains_are_those_of_the_likelihood():
    """What move() goes by equals the likelihood of the counts with the word in each class."""
    rng = np.random.default_rng(3)
    k = 5
    for _ in range(30):
        words = 12
        pairs = rng.integers(0, 4, (words, words)).astype(float)
        classes = rng.integers(0, k, words)
        put = lambda c: np.array([[pairs[np.ix_(c == i, c == j)].sum() for j in range(k)] for i in range(k)])
        w = int(rng.integers(words))
        others = np.arange(words) != w
        before = np.bincount(classes[others], weights=pairs[others, w], minlength=k)
        after = np.bincount(classes[others], weights=pairs[w, others], minlength=k)
        state = lm.Exchange(put(classes))
        state.shift(int(classes[w]), before, after, pairs[w, w], -1)
        gains = state.gains(before, after, pairs[w, w])
        moved = [np.where(np.arange(words) == w, c, classes) for c in range(k)]
        want = np.array([lm.likelihood(put(m)) for m in moved])
        assert np.allclose(gains - gains[0], want - want[0])
        state.shift(int(classes[w]), before, after, pairs[w, w], 1)
        new = state.move(int(classes[w]), before, after, pairs[w, w], k)
        assert np.isclose(want[new], want.max()) and np.allclose(state.m, put(moved[new]))
        assert np.allclose(state.rows, state.m.sum(axis=1)) and np.allclose(state.cols, state.m.sum(axis=0))


@pytest.mark.parametrize("frequent,chunk", [(lm.FREQUENT, lm.CHUNK_TOKENS), (40, 50)])
def test_scores_by_hand(spark, monkeypatch, frequent, chunk):
    """Classes of frequent words from the operator; all that follows from them by hand: class counts, other words' classes, probabilities, scores."""
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)
    rng = np.random.default_rng(7)
    vocabulary = [f"W{i}" for i in range(60)] + ["ÄÖ", "x" * 100]
    docs = [(i, " ".join(rng.choice(vocabulary[(i % 2) * 30:][:32], int(rng.zipf(1.6)) % 40))) for i in range(80)] + [(100, None), (None, "W1 W1 W2"), (101, "x" * 100 + " new")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    k = 6
    train, rows = check_base(lm.score(df, lm.held_out(), k=k, frequent=frequent), docs)
    n = sum(train.values())
    corpus = lm.corpus_of(chunks := lm.chunks_of(df, lm.held_out(), "doc_id", "text"), frequent)
    assert (corpus.n, corpus.v, corpus.singles) == (n, len(train), sum(c == 1 for c in train.values()))
    assert set(corpus.words) == {lm.key_of(w) for w, c in train.items() if c * frequent >= n or w == END}
    found, m = lm.frequent_classes(chunks, corpus, k)
    classes = {w: int(found[corpus.words[lm.key_of(w)]]) if lm.key_of(w) in corpus.words else k - 1 for w in train}
    pairs = Counter()
    for i, t in docs:
        if not is_held(i):
            said = tokens_of(t)
            pairs.update(zip([END, *said], said))
    count = lambda cls: np.array([[sum(x for (a, b), x in pairs.items() if cls[a] == i and cls[b] == j) for j in range(k)] for i in range(k)], float)
    assert np.array_equal(m, count(classes))
    start = {w: corpus.words.get(lm.key_of(w), k - 1) % (k - 1) if lm.key_of(w) in corpus.words else k - 1 for w in train}
    assert lm.likelihood(m) >= lm.likelihood(count(start))
    smooth, final = m + 1 / k, dict(classes)
    for w in train:
        if lm.key_of(w) not in corpus.words:
            def gain(c):
                before = sum(x * (math.log(smooth[classes[a], c]) - math.log(smooth[:, c].sum())) for (a, b), x in pairs.items() if b == w)
                return before + sum(x * (math.log(smooth[c, classes[b]]) - math.log(smooth[c].sum())) for (a, b), x in pairs.items() if a == w)
            final[w] = max(range(k), key=lambda c: (round(gain(c), 9), -c))
    m2, unseen = count(final), (corpus.singles + 0.5) / (n + 1)
    size = Counter(final[w] for w in train.elements())

    def p(before, w):
        if w not in train:
            return unseen
        c, share = final[w], size[final[w]] / n
        of_class = share if before not in train else (m2[final[before], c] + lm.SMOOTHING * share) / (m2[final[before]].sum() + lm.SMOOTHING)
        return (1 - unseen) * of_class * train[w] / size[c]

    for before in [END, b"w1", b"no such word"]:
        assert math.isclose(sum(p(before, w) for w in train) + unseen, 1, rel_tol=1e-9)
    want = {i: sum(math.log10(p(a, b)) for a, b in zip([END, *tokens_of(t)], tokens_of(t))) for i, t in docs}
    assert all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-9) for r in rows) and len(rows) == len(docs)
    if frequent == 40:
        assert len(corpus.words) < len(train) - 10


def test_odd_rows(spark, edge_docs, empty_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check_base(lm.score(edge_docs, lm.held_out(), k=4), docs)
    assert lm.score(empty_docs, lm.held_out()).count() == 0
    held = next(i for i in range(100) if is_held(i))
    alone = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), lm.held_out()).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score, alone.score) == (3, 0, 0, 0.0, 0.0)


def test_held_out_texts_gain(spark):
    """The query over its table: base columns by hand, and the model says more of held-out texts than the base does."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    _, rows = check_base(queries.op13_class_lm(spark, SF0001), docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held) and sum(r.score for r in held) > sum(r.base_score for r in held)
