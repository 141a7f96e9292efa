"""Decontamination, near duplicates, main text, languages and the pipeline against brute force."""
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from edge_tables import SF0001, edge_docs, empty_docs  # noqa: F401
from heartspark.llm import byte_bpe, decontaminate, html_text, language_id, near_dups, quality, queries, secrets


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


# -- decontamination ---------------------------------------------------------------------------------------------


def overlaps_by_hand(docs, items, stretch=13, least=0.8):
    """All alignments of all pairs: a seed hit, and a stretch over its window with enough equal tokens."""
    span, out = decontaminate.SPAN, {}
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    for d, doc in docs:
        for i, item in items:
            hits = set()
            if len(item) < stretch:
                for p in range(len(doc) - len(item) + 1):
                    same = [a == b for a, b in zip(item, doc[p:])]
                    if item and any(all(same[k] for k in m) for m in decontaminate.masks_of(len(item), least)) and sum(same) / len(item) >= least:
                        hits.add((p, 0, sum(same) / len(item)))
            for p in () if len(item) < stretch else range(len(doc) - span + 1):
                for q in range(len(item) - span + 1):
                    if any(all(doc[p + k] == item[q + k] for k in m) for m in masks):
                        n = min(stretch, len(item))
                        for a in range(p - n + 1, p + span):
                            b = a - p + q
                            if a >= 0 and b >= 0 and a + n <= len(doc) and b + n <= len(item):
                                share = sum(doc[a + k] == item[b + k] for k in range(n)) / n
                                if share >= least:
                                    hits.add((p, q, share))
            if hits:
                out[d, i] = (len({h[:2] for h in hits}), max(h[2] for h in hits))
    return out


def test_overlaps(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.choice([1, 4, 5, 9, 10, 12, 13, 15, 40]))) for i in range(24)]
    docs = []
    for d in range(60):
        doc = text(rng.randrange(0, 60))
        if d % 2:
            passage = list(rng.choice(items)[1])
            for _ in range(rng.randrange(0, 5)):
                passage[rng.randrange(len(passage))] = "other"
            doc[10:10] = passage[:rng.randrange(5, 41)]
        docs.append((d, doc))
    want = overlaps_by_hand(docs, items)
    frame = lambda rows, name: spark.createDataFrame([(i, " ".join(t).upper() + ".") for i, t in rows], f"{name} long, text string")
    for bound in (decontaminate.MOST_SEEDS, 0):
        got = decontaminate.overlaps(frame(docs, "doc_id"), frame(items, "item_id"), most_seeds=bound)
        got = {(r.doc_id, r.item_id): (r.n_hits, r.share) for r in got.collect()}
        assert {k: (n, round(s, 9)) for k, (n, s) in got.items()} == {k: (n, round(s, 9)) for k, (n, s) in want.items()}
    assert 20 < len(want) < 90 and len({len(items[i][1]) for _, i in want}) >= 5


def test_no_accepted_pattern_is_without_a_seed():
    """Of items from one token on, and of a lone stretch of longer ones, every choice of substitutions that verification accepts."""
    for n in range(1, 14):
        for k in range(n + 1):
            if (n - k) / n < 0.8:
                break
            for gone in itertools.combinations(range(n), k):
                if n < 13:
                    found = any(not set(gone) & set(m) for m in decontaminate.masks_of(n, 0.8))
                else:
                    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
                    found = any(all(a + i not in gone for i in m) for m in masks for a in range(n - decontaminate.SPAN + 1))
                assert found, (n, gone)


def test_op2_finds_whole_passages(spark):
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()}
    first = defaultdict(set)
    for i, t in items.items():
        first[tuple(t[:15])].add(i)
    want = set()
    for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect():
        t = words(r.text)
        for p in range(len(t) - 14):
            want |= {(r.doc_id, i) for i in first.get(tuple(t[p:p + 15]), ()) if t[p:p + len(items[i])] == items[i]}
    got = {(r.doc_id, r.item_id) for r in queries.op2_spaced_seeds(spark, SF0001).collect()}
    assert want and want <= got and len(got - want) <= 0.05 * len(want)


def test_overlap_edges(spark, edge_docs, empty_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (None, "a b c d e f g h i j k"), (4, "Ein sehr langer Satz the of and Ein sehr langer Satz"),
                                   (5, "ein sehr langer satz the of and ein sehr langer satz")], "item_id long, text string")
    got = decontaminate.overlaps(edge_docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(4, 4)}
    assert {r.item_id: r.class_id for r in decontaminate.classes(bench).collect()}[5] == 4
    assert decontaminate.overlaps(empty_docs, bench).count() == 0
    assert decontaminate.overlaps(edge_docs, bench.where("false")).count() == 0
    left = decontaminate.clean(edge_docs, bench)
    assert left.columns == edge_docs.columns and left.count() == 10


# -- near duplicates ---------------------------------------------------------------------------------------------


def bag(text):
    w = words(text)
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def classes_by_hand(texts):
    bags = {i: bag(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(bags):
        common = Counter()
        for s, n in bags[i].items():
            for j, m in holders[s]:
                common[j] += min(n, m)
            holders[s].append((i, n))
        for j, n in common.items():
            if n >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_signature_is_unbiased():
    """Registers agree with the probability of the weighted Jaccard similarity, also for counts inside a block."""
    rng = np.random.default_rng(2)
    errors = []
    for k in range(12):
        a, b = rng.integers(0, 4 + 3 * k, 50), rng.integers(0, 4 + 3 * k, 50)
        b = np.where(rng.random(50) < 0.6, a, b)
        h = near_dups.mix(np.arange(50, dtype=np.uint64) + np.uint64(1000 * k + 1))
        doc = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = near_dups.signatures(doc, np.concatenate([h[a > 0], h[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, m=3000)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.012 and np.max(np.abs(errors)) < 0.05


def test_near_duplicates(spark, edge_docs, empty_docs):
    rng = random.Random(9)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts, i = {}, 0
    hub = text(200)
    for _ in range(40):  # copies of an original, each with edits of its own, and exact copies
        copy = list(hub)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(200)] = f"x{rng.randrange(10 ** 6)}"
        texts[i] = " ".join(copy)
        i += 1
    chain = text(120)
    for _ in range(12):  # a chain, whose ends aren't similar
        chain = chain[2:] + text(2)
        texts[i] = " ".join(chain)
        i += 1
    for _ in range(60):
        texts[i] = " ".join(text(rng.randrange(1, 80)))
        i += 1
    for repeat in ("a b c d e " * 30, "a b c d e " * 29, "a b c d e " * 3, "one two", "one two", "one"):
        texts[i] = repeat
        i += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = near_dups.near_duplicates(df)
    assert {r.doc_id: r.class_id for r in got.collect()} == classes_by_hand(texts)
    edges = near_dups.near_duplicates(edge_docs).collect()
    assert {(r.doc_id, r.class_id, r.n_shingles) for r in edges} >= {(1, 1, 0), (2, 2, 0), (3, 3, 0), (6, 6, 1), (None, None, 0), (5, 5, 1)}
    assert near_dups.near_duplicates(empty_docs).count() == 0
    kept = near_dups.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == 11


def test_near_duplicates_of_ids_with_two_texts(spark):
    """The greatest multiset of an id counts in its signature and in its overlaps."""
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows = []
    for k in range(0, 48, 4):
        great, small = text(100 + k), text(60)
        rows += [(k, great), (k, small), (k + 1, [*great[:-1], "x"]), (k + 2, [*small[:-1], "x"]), (k + 3, text(50))]
    greatest = {i: " ".join(max((t for j, t in rows if j == i), key=len)) for i, _ in rows}
    got = near_dups.near_duplicates(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string"))
    want = classes_by_hand(greatest)
    assert {r.doc_id: r.class_id for r in got.collect()} == want and want[1] == 0 and want[2] == 2


def test_op7_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    assert {r.doc_id: r.class_id for r in queries.op7_bag_minhash(spark, SF0001).collect()} == classes_by_hand(texts)


# -- main text ---------------------------------------------------------------------------------------------------

PAGES = [
    ("", ""), (None, ""),
    ("<article><h1>T &amp; U</h1><p>One  two<br>three.<p>Of.</article><footer>&copy; x. All rights. Reserved.</footer>", "T & U One two three. Of."),
    ("<nav><a href='/'>Home page</a></nav><main><p title='a>b'>Long enough text here.</p><aside>Buy this now. Really.</aside><p>End.</p></main>", "Long enough text here. End."),
    ("<article><p>Text one of it.</p><div class='ad'>Buy now. Cheap.</div><p>Text two of it.</p><section id=comments><p>I agree with this article. Very much so.</p></section></article>",
     "Text one of it. Text two of it."),
    ("<script>var a='</p><p>no';</script><style>p{}</style><!-- <p>no</p> --><p>Only this sentence is text.</p>", "Only this sentence is text."),
    ("<div class='cookie-notice'><p>We use cookies. Accept them all.</p></div><p>Bo<b>ld</b> words, in a sentence.</p>", "Bold words, in a sentence."),
    ("<form><p>Your name. And your address.</p></form><article><ul><li>First item.<li>Second item.</ul></article>", "First item. Second item."),
]


def test_main_text_of_small_pages():
    for page, want in PAGES:
        assert html_text.main_text(page or "") == want


def test_min_cut_is_minimal():
    """Against all labellings."""
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 8)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(kept):
            return sum(abs(z) for z, k in zip(odds, kept) if (z > 0) != k) + sum(w for a, b, w in edges if kept[a] != kept[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.min_cut(odds, edges)) == pytest.approx(best)


def test_op3_articles(spark):
    """The synthetic pages keep their text in one article element."""
    import html
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op3_html_min_cut(spark, SF0001).collect()}
    assert len(got) == len(pages)
    for i, page in pages.items():
        blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in blocks]
        want = " ".join(b for b in blocks if b)
        assert (got[i].text, got[i].n_chars) == (want, len(want))


def test_pages_edges(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>" + "Word and word. " * 50_000, "x"), (2, "u", "<" * 9000, "y"), (2, "u", "<" * 9000, "y")],
                               "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 9000, 9000, 15 * 50_000 - 1]
    assert html_text.extract(df.where("false")).count() == 0


# -- languages ---------------------------------------------------------------------------------------------------


def test_op8_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op8_language_filters(spark, "/root/testdata/sf0.01").collect()}
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(got) == len(docs)
    tested = [i for i in got if got[i].held_out]
    assert len(tested) > 200
    assert sum(got[i].lang_pred == docs[i].lang for i in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_filter_contains_what_it_learned(spark):
    """Against sets of n-grams: no false negatives, and few false positives."""
    rows = [("aa", "alpha beta gamma delta"), ("aa", "alpha beta"), ("bb", "delta omega sigma"), ("bb", "omega delta"), (None, "zzzz"), ("cc", None)]
    learned = language_id.learn(spark.createDataFrame(rows, "lang string, text string"), least=1, part=0.0)
    assert learned.languages == ["aa", "bb"]
    sets = {k: set(np.concatenate([language_id.grams(language_id.points(t)) for x, t in rows if x == k and t]).tolist()) - {0} for k in ("aa", "bb")}
    for k, name in enumerate(learned.languages):
        h = np.array(sorted(sets["aa"] | sets["bb"]), np.uint64)
        bits = (learned.masks(h)[:, 0] >> k & 1).astype(bool)
        assert all(bits[i] for i in range(len(h)) if int(h[i]) in sets[name])
        assert sum(bits) <= len(sets[name]) + 2
    assert learned.predict(["alpha beta", "omega", None, "12 !", "xyxyxyxy", ""])[0] == ["aa", "bb", "und", "und", "aa", "und"]


def test_language_edges(spark, edge_docs, empty_docs):
    learned = language_id.learn(edge_docs)
    got = language_id.predict(edge_docs, learned).collect()
    assert len(got) == 11 and {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 8)} == {"und"}
    nothing = language_id.learn(empty_docs)
    assert {r.lang_pred for r in language_id.predict(edge_docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty_docs, learned).count() == 0


def test_many_languages(spark):
    """More languages than bits of an integer."""
    rows = [(f"l{k:03d}", f"{chr(97 + k % 26)}{chr(97 + k // 26)}qx{chr(97 + k % 26)} " * 5) for k in range(80)]
    learned = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert learned.slots.shape[1] == 2
    assert learned.predict([t for _, t in rows])[0] == [k for k, _ in rows]


# -- pipeline ----------------------------------------------------------------------------------------------------


def shares_a_stretch(doc, item, stretch=13, least=0.8):
    """Whether some aligned stretch of both has enough equal tokens, by all alignments, without seeds."""
    n = min(stretch, len(item))
    if not n or len(doc) < n:
        return False
    same = (np.array(doc, object)[:, None] == np.array(item, object)[None, :]).astype(int)
    sums = sum(same[k:len(doc) - n + 1 + k, k:len(item) - n + 1 + k] for k in range(n))
    return bool(sums.max() >= least * n)


def test_pipeline(spark):
    """Stage after stage against versions apart from the operators: quality by SQL, classes by all pairs, overlaps by all alignments, secrets by
    regular expression, ids by decoding."""
    import duckdb
    import public_tokenizers
    from heartspark.llm import oracles
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF0001}/documents.parquet'")
    answer = con.execute(oracles.quality())
    names = [d[0] for d in answer.description]
    kept = {r[names.index("doc_id")] for r in answer.fetchall() if r[names.index("kept")]}
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    assert 100 < len(kept) < len(rows)
    classes = classes_by_hand({i: rows[i].text for i in kept})
    kept = {i for i in kept if classes[i] == i}
    items = [words(r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    found = {i for i in kept if any(shares_a_stretch(words(rows[i].text), t) for t in items)}
    assert found and found < kept
    kept -= found
    codec = byte_bpe.Codec(queries.rank_file(), public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF0001).collect()}
    assert set(got) == kept
    secret = re.compile("|".join(r.pattern.replace("(?i:", "(?:") for r in secrets.RULES))
    for i, r in got.items():
        text = codec.decode(r.ids).decode()
        assert r.exact and r.n_tokens == len(r.ids)
        if "[REDACTED]" not in text:
            assert text == rows[i].text
        else:
            assert secret.search(rows[i].text)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    for empty in (docs, docs.where("false")):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            if k in (0, 3) or empty is not docs:
                out = stage(spark, empty, SF0001)
                assert out.dtypes == docs.dtypes
                out.count()
    assert corpus_pipeline.encode(spark, docs.where("false"), SF0001).count() == 0


HOSTILE = {
    "nested": "<div>" * 100_000 + "x", "nested text": "<div>some text " * 70_000, "unclosed tags": "<a " * 330_000, "quotes": '<a "' * 250_000,
    "data": "<![CDATA[>" * 100_000, "comments": "<!--" * 250_000, "inline": "<i>" * 300_000 + "</b>" * 10,
    "ends beyond a block": "<b><div>" + "<i>" * 150_000 + "</b>" * 150_000, "paragraphs": "<p>word. " * 120_000, "items": "<ul><li>" * 100_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_linear_time(name):
    """1 MB of what makes a scanner go back: no more than some seconds, as four times that takes about four times as long."""
    import time
    page, took = HOSTILE[name], []
    for part in (page[:len(page) // 4], page):
        started = time.process_time()
        html_text.main_text(part)
        took.append(time.process_time() - started)
    assert took[1] < 10 and took[1] < 12 * took[0] + 1


def test_scanner():
    """Quotes may hold marks, unclosed markup is text, ends reach their element, implied ends stop at containers."""
    say = lambda page: [b.text for b in html_text.blocks_of(page)]
    assert say('a<img alt="x>y">b<p title=\'<b>\'>c<p>d') == ["ab", "c", "d"]
    assert say("1 < 2 <b>and</b> 3 <div") == ["1 < 2 and 3 <div"]
    assert say("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == ["a", "b", "c", "d"]
    assert say("<b>x<div>y</b>z</div>w") == ["x", "yz", "w"]
    assert say("<script>if (a<b) '</p>'</script>t<!-- <p>no --><![CDATA[ no ]]>u<!-- rest") == ["tu"]
    near = html_text.blocks_of("<div><p>a</p><p>b</p></div><div><p>c</p></div>d")
    assert [(b.depth, b.common) for b in near] == [(2, 0), (2, 1), (2, 0), (0, 0)]


def grams_by_hand(text):
    """Windows of four characters with two letters in the middle, and one-letter words, of the lower-case text with blanks for all that is no letter."""
    said = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    out = []
    for i in range(len(said) - 2):
        w = said[i:i + 4].ljust(4, "\0")
        if w[1] != " " and w[2] != " " and w[3] != "\0":
            out.append(w)
        elif w[0] == " " and w[1] != " " and w[2] == " ":
            out.append(w[:3])
    return out


def test_languages_equal_exact_sets(spark):
    """The filter's answers against sets of n-grams without chance hits: the same language, nearly the same score."""
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    train = [r for r in rows if r.lang is not None and r.text is not None and r.doc_id % 3]
    counts = defaultdict(Counter)
    for r in train:
        counts[r.lang].update(grams_by_hand(r.text))
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    top = defaultdict(float)
    for lang, c in counts.items():
        for g, n in c.items():
            top[g] = max(top[g], n / totals[lang])
    members = {lang: {g for g, n in c.items() if n >= 2 and n / totals[lang] >= 0.1 * top[g]} for lang, c in sorted(counts.items())}
    learned = language_id.learn(spark.createDataFrame([(r.text, r.lang) for r in train], "text string, lang string"))
    texts = [r.text for r in rows] + ["a", "", None, "12 ?", "zq zq", "\u00e9 \u00e0 la"]
    langs, scores = learned.predict(texts)
    for text, lang, score in zip(texts, langs, scores):
        own = grams_by_hand(text or "")
        if not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0.0)
            continue
        hits = {x: sum(g in m for g in own) for x, m in members.items()}
        best, total = max(hits.values()), sum(hits.values())
        if total == 0:
            assert score == 0.0 and lang == max(sorted(totals), key=lambda x: totals[x])
        elif best >= sorted(hits.values())[-2] + 3:  # a chance hit can't turn it
            assert lang == max(sorted(hits), key=lambda x: hits[x]) and abs(score - best / total) < 0.02
