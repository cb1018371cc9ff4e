"""Language CRF, lattice scores, neighbours, pages, queries and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle_harness import compare, duck
from tunelake.llm import ann, langid, lattice, pages, scoring
from tunelake.llm.oracle import ORACLE
from tunelake.llm.queries import QUERIES, tokenizer_path

PIECES = "piece_bpe_32k.model"


def test_held_out_accuracy(spark, small_dir):
    out = QUERIES["op7_langid"](spark, small_dir).join(
        spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out and lang is not null")
    assert held.filter("lang = lang_pred").count() >= 0.95 * held.count()
    assert out.filter("score < 0 or score > 1").count() == 0


def test_language_of_messy_rows(messy_docs, messy, no_docs):
    out = langid.identify(messy_docs).select("doc_id", "text", "language.*").collect()
    assert len(out) == len(messy)
    for r in out:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and (letter or r.score == 0)
    assert langid.identify(no_docs).count() == 0
    blind = langid.identify(messy_docs.withColumn("lang", F.lit(None).cast("string")))
    assert blind.filter("language.lang_pred <> 'und'").count() == 0


def test_code_switch_is_labelled_word_by_word():
    rng = np.random.default_rng(2)
    words = {"a": ["thing", "ouble", "the"], "b": ["schung", "keit", "ver"]}
    samples = [(k, " ".join(rng.choice(v, 80))) for k, v in words.items() for _ in range(20)]
    model = langid.train(samples, bits=12)
    text = ["thing"] * 10 + ["keit"] * 10 + ["the"] * 5
    p = langid._marginals(langid._evidence(text, model.weights), np.array([25]), model.moves)
    assert p.argmax(1).tolist() == [0] * 10 + [1] * 10 + [0] * 5
    assert model.moves[0, 0] > model.moves[0, 1]


@pytest.mark.parametrize("few", [16, 1])
def test_marginals_match_plain_forward_backward(monkeypatch, few):
    monkeypatch.setattr(langid, "_FEW", few)
    rng = np.random.default_rng(0)
    counts = np.array([1, 200, 64, 65, 3])
    scores, moves = rng.normal(size=(counts.sum(), 3)), rng.normal(size=(3, 3))
    got, at = langid._marginals(scores, counts, moves), 0
    for n in counts:
        pot, step = np.exp(scores[at:at + n]), np.exp(moves)
        f, b = np.empty((n, 3)), np.empty((n, 3))
        now = np.full(3, 1 / 3)
        for t in range(n):
            now = (now @ step) * pot[t]
            f[t] = now = now / now.sum()
        now = np.full(3, 1 / 3)
        for t in range(n - 1, -1, -1):
            b[t] = now
            now = step @ (pot[t] * now)
            now = now / now.sum()
        want = f * b / (f * b).sum(1, keepdims=True)
        assert np.allclose(got[at:at + n], want)
        at += n


def test_lattice_sums_all_segmentations():
    pieces = ["▁a", "b", "ab", "▁", "a", "▁ab", "bb"]
    vocab = lattice.vocabulary(pieces)
    p = np.log(np.full(vocab.end + 1, 1 / (vocab.end + 1)))
    lat = lattice.Lattice(vocab, p)
    probs = dict(zip(pieces, np.exp(p)))

    def plain(word):
        text, total = "▁" + word, [1.0]
        for j in range(1, len(text) + 1):
            byte = math.prod(math.exp(p[vocab.first_byte + b]) for b in text[j - 1].encode())
            total.append(total[j - 1] * byte + sum(total[i] * probs[text[i:j]]
                                                   for i in range(j) if text[i:j] in probs))
        return math.log(total[-1])

    words = ["a", "ab", "abb", "abab", "é", "b" * 40]
    assert np.allclose(lat.log_prob(words), [plain(w) for w in words])
    use = lat.expected(words, np.ones(len(words)))
    for i in (0, 2, vocab.first_byte + ord("b")):
        q = p.copy()
        q[i] += 1e-6
        slope = (lattice.Lattice(vocab, q).log_prob(words).sum() - lat.log_prob(words).sum()) / 1e-6
        assert abs(slope - use[i]) < 1e-4


@pytest.mark.parametrize("frequent", [100_000, 5])
def test_scores(messy_docs, messy, no_docs, frequent):
    out = scoring.score(messy_docs, tokenizer_path(PIECES), frequent=frequent).collect()
    assert len(out) == len(messy)
    low = [scoring._lower_words(r[1]) for r in messy]
    train = [ws for r, ws in zip(messy, low)
             if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()) + len(train), len(c) + 1

    def token(k):
        return math.log10((k + 1) / (n + v + 1))

    want = sorted((-1 if r[0] is None else r[0], len(ws) + 1, 1 + sum(c[w] > 0 for w in ws), n,
                   round(sum(token(c[w]) for w in ws) + token(len(train)), 6))
                  for r, ws in zip(messy, low))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens,
                  round(r.base_score, 6)) for r in out)
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    assert scoring.score(no_docs, tokenizer_path(PIECES)).count() == 0


def test_scores_match_a_plain_lattice_model(spark):
    """The whole score: training words, three rounds of fitting, the sum over all segmentations."""
    import brute
    import sentencepiece
    path = tokenizer_path(PIECES)
    rows = [(i, t) for i, t in enumerate(["the cat sat", "The CAT é x²", "unseen wörds here", None, "", "a a a b",
                                          "the the cats", "zzzqqq \U0001f600", "sat on the mat", "on on"])]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (
        model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    _, log_p = scoring.load_vocabulary(path)
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    want = brute.lattice_scores(rows, {x: i for i, x in enumerate(names)}, np.exp(log_p).tolist(), train)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in scoring.score(docs, path, frequent=3).collect()}
    assert len(names) + 257 == len(log_p) and any(train) and not all(train)
    assert all(abs(got[i] - w) < 1e-6 for i, w in enumerate(want))


def test_fitted_weights_score_better(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    total = [scoring.score(docs, tokenizer_path(PIECES), rounds=k).filter("held_out")
             .agg(F.sum("score")).first()[0] for k in (1, 3)]
    assert total[1] > total[0]


def vectors(spark, rows, extra="label int, bucket int, q long"):
    return spark.createDataFrame([r + (1, 2, 3) for r in rows], f"vec_id long, embedding array<float>, {extra}")


@pytest.mark.parametrize("odd", ['<svg class="x"/>', "<select><option>", "<object data=x>", "<iframe src=y>",
                                 "<svg><svg></svg><g/></svg>"])
def test_unclosed_elements_hide_no_text(odd):
    page = f"<body>{odd}<article><p>one</p></article><svg><text>no</text></svg><p>two</p>"
    assert pages.page_lines(page)[0] == ["one", "two"]
    assert pages.page_lines("<p>a</p><object>x<object>y</object>z</object><p>b</p>")[0] == ["a", "b"]
    assert pages.page_lines("<p>a</p><script>never closed <p>b</p>")[0] == ["a"]


def test_neighbours_recall(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16)).astype(np.float32) * rng.uniform(0.5, 2, (600, 1)).astype(np.float32)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    for block in (4096, 16):
        out = ann.search(df, F.col("vec_id") % 20 == 0, block=block).collect()
        hits = 0
        for q in range(0, 600, 20):
            s = x.astype(float) @ x[q].astype(float)
            want = [j for j in np.lexsort((np.arange(600), -s)) if j != q][:20]
            mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
            assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
            assert all(abs(r.score - s[r.vec_id]) < 1e-9 for r in mine)
            hits += len({r.vec_id for r in mine} & set(want))
        assert hits >= 0.9 * 20 * 30


def test_neighbours_recall_with_two_rotations(spark):
    """Neighbours no nearer than where the second rotation begins (cosine about 0.51)."""
    rng = np.random.default_rng(6)

    def unit(v):
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    x = unit(rng.normal(size=(1000, 64)))
    for q in range(0, 400, 20):
        away = rng.normal(size=(20, 64))
        away = unit(away - np.outer(away @ x[q], x[q]))
        x[500 + q:520 + q] = 0.51 * x[q] + np.sqrt(1 - 0.51 ** 2) * away
    x = x.astype(np.float32)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    asks = (F.col("vec_id") % 20 == 0) & (F.col("vec_id") < 400)
    found = Counter((r.query_id, r.vec_id) for r in ann.search(df, asks, turns=2).collect())
    hits = 0
    for q in range(0, 400, 20):
        s = x.astype(float) @ x[q].astype(float)
        hits += sum(found[q, j] for j in [j for j in np.argsort(-s) if j != q][:20])
    assert hits >= 0.9 * 20 * 20
    with pytest.raises(ValueError):
        ann.search(df, asks, turns=3)


def test_scores_of_double_vectors_are_not_rounded(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=3).collect():
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-14


def test_neighbours_of_copies_and_bad_vectors(spark):
    same = [1.0, 0.0, 0.0]
    rows = [(i, same) for i in range(60)] + [(60, [0.9, 0.1, 0.0]), (61, None), (62, [0.0, 0.0, 0.0]),
            (63, [float("nan"), 1.0, 0.0]), (64, [float("inf"), 0.0, 1.0]), (65, [1.0, None, 0.0]),
            (66, [1.0]), (67, []), (None, same), (0, same)]
    out = ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert {r.query_id for r in out} == {0, 20, 40, 60}
    for q in (0, 20, 40):
        mine = sorted((r["rank"], r.vec_id, r.score) for r in out if r.query_id == q)
        assert [v for _, v, _ in mine] == [i for i in range(60) if i != q][:20]
        assert {s for _, _, s in mine} == {1.0}
    assert ann.search(vectors(spark, [])[["vec_id", "embedding"]], F.col("vec_id") > 0).count() == 0
    two = ann.search(vectors(spark, rows[-8:-6] + [(1, same), (2, same)]), F.col("vec_id") >= 0)
    assert {(r.query_id, r.vec_id) for r in two.collect()} == {(1, 2), (2, 1)}


PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{a:b}</style></head><body><nav><ul><li>Menu"
        "</ul></nav><div class='cookie-notice'>We use cookies<p>ok</div><article><h1>A &amp; B</h1><p>One\n"
        "  two<p>three<br>four <b>five</article><aside>side</aside><div id=comments><p>First!</div>"
        "<script>var a='</p><p>x';</script><footer>&copy; x</footer>")


def test_article_text():
    assert pages.main_text(*pages.page_lines(PAGE)) == "A & B\n\nOne two\n\nthree four five"
    assert pages.page_lines(None) == ([], []) and pages.main_text([], []) == ""


def test_shared_lines_are_deleted_without_an_article(spark):
    def page(i):
        return (f"<div>Site name</div><p>Text {i} alone</p><p>Same tail</p><div>Imprint</div>")

    rows = [(i, f"https://h.org/a/{i}", page(i), "x", 1) for i in range(4)]
    rows += [(10, "https://other.org/a", page(10), "x", 1), (11, None, None, "x", 1), (None, "::bad[", "", "x", 1),
             (1, "https://h.org/a/1", page(1), "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, row long")
    out = sorted((str(r.page_id), r.text) for r in pages.extract(df).collect())
    assert ("0", "Text 0 alone") in out and ("3", "Text 3 alone") in out
    assert ("10", "Site name\n\nText 10 alone\n\nSame tail\n\nImprint") in out
    assert ("11", "") in out and ("None", "") in out and len(out) == len(rows)
    assert pages.extract(df.limit(0)).count() == 0


def test_every_page_is_aligned_and_template_inside_articles_is_deleted(spark):
    """Before, the alignment saw no page whose article holds its text."""
    def page(i, *more):
        return (f"<nav><p>Menu</p></nav><article><h1>Title {i}</h1><p>Read more in our app</p><p>Body {i}</p>"
                + "".join(f"<p>{x}</p>" for x in more) + "</article>")

    def want(i, *more):
        return "\n\n".join([f"Title {i}", f"Body {i}", *more])

    app = "Read more in our app"
    quote = {5: ["As they said"], 6: ["As they said"]}          # neighbours that quote one line keep it
    rows = [(i, f"https://h.org/{i:02d}", page(i, *quote.get(i, ()))) for i in range(20)]
    rows += [(20 + i, f"https://h.org/zz{i}", page(99, "last")) for i in range(2)]        # copies stay whole
    rows += [(30 + i, f"https://few.org/{i}", page(i)) for i in range(4)]                 # too few to tell
    rows += [(40 + i, f"https://same.org/{i}", page(7, "same")) for i in range(12)]       # a group of copies
    rows += [(60, "https://h.org/10/x", f"<article><p>{app}</p></article>")]              # nothing else: kept
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == want(i, *quote.get(i, ())) for i in range(20))
    assert got[20] == got[21] == want(99, "last") and got[60] == app
    assert all(got[30 + i] == f"Title {i}\n\n{app}\n\nBody {i}" for i in range(4))
    assert all(got[40 + i] == f"Title 7\n\n{app}\n\nBody 7\n\nsame" for i in range(12))


def test_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = (rng.choice(list("abc"), rng.integers(0, 9)).tolist() for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert len(pages.shared_lines(a, b)) == best[-1, -1]


def test_pages_keep_whole_articles(spark, small_dir):
    import html
    import re
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    for r in QUERIES["op10_pages"](spark, small_dir).collect():
        inner = re.search(r"<article>(.*?)</article>", raw[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, small_dir, name):
    got = compare(QUERIES[name](spark, small_dir), duck(small_dir), ORACLE[name])
    assert got["ok"], got


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "substring dedup", "mixing", "packing"]


def test_pipeline_stages(spark, messy_docs, messy, no_docs):
    """Each stage against a plain version on its own input."""
    import brute
    docs = messy_docs.select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.language(spark, docs, None)
    assert kept.columns == docs.columns
    left = [tuple(r) for r in kept.collect()]
    assert all(any(c.isalpha() for c in r[1]) for r in left) and len(left) >= 60

    once = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, kept, None).collect()]
    prints = [brute.simhash(r[1]) for r in left]
    by_text = dict(zip([r[1] for r in left], prints))
    group = brute.near_components([(i, f) for i, f in enumerate(prints)], 4)
    assert len(once) == len(set(group))
    for g in set(group):
        ids = [left[i][0] for i in range(len(left)) if group[i] == g and left[i][0] is not None]
        members = {by_text[left[i][1]] for i in range(len(left)) if group[i] == g}
        stays = [r for r in once if by_text[r[1]] in members]
        assert len(stays) == 1 and stays[0][0] == (min(ids) if ids else None)

    docs2 = spark.createDataFrame(once, docs.schema)
    clean = corpus_pipeline.repeated_passages(spark, docs2, None).collect()
    want = [(str(d), n - gone) for d, n, gone, _ in brute.passages([r[:2] for r in once])]
    assert sorted((str(r.doc_id), len(brute.words(r.text))) for r in clean) == sorted(want)
    before = {(r[0], r[1]): r[4] for r in once}
    for r in clean:
        assert r.n_chars == before.get((r.doc_id, r.text), len(r.text))

    mixed = corpus_pipeline.mixture(spark, docs2, None)
    assert mixed.columns == docs.columns and mixed.join(docs2, "doc_id", "left_anti").count() == 0
    assert corpus_pipeline.sequences(spark, mixed, None).count() > 0
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, None)
    assert empty.count() == 0


def test_comments_inside_the_main_element_are_outside():
    page = ("<main><article><p>Story</article><section class='comments'><article><p>Nice</article></section>"
            "<article class='comment'><p>Bad</article></main>")
    assert pages.main_text(*pages.page_lines(page)) == "Story"


@pytest.mark.parametrize("page,text", [
    ('<div class="content with-sidebar"><p>body</p></div>', "body"),
    ('<article><p>a</p><div class="market-share"><p>b</p></div><section class="related-work">c</section></article>',
     "a\n\nb\n\nc"),
    ("<article><h1>t</h1></article><div><p>the body of the text</p></div>", "t\n\nthe body of the text"),
    ('<div class="page widget"><main><p>x</p></main></div>', "x"),
    ('<div class="widget"><p>nearly all of the text there is</p></div><p>end</p>', "nearly all of the text there is\n\nend"),
    ('<article><p>long text of the article</p></article><div class="cookie-notice">c</div><div id="comments">'
     '<p>a comment that is much longer than the article itself, by far</p></div>', "long text of the article"),
    ('<article><p>text</p><div class="share-bar">s</div><div class="ad">ad</div></article><p>by</p>', "text"),
    ('<p>a</p><div class="site-header">h</div><p>b <svg><svg></svg>x</svg> c</p>', "a\n\nb c"),
    ("<p title='it\"s > x'>a</p><p title=\"open>b</p>", "a\n\nb"),
])
def test_no_text_is_lost_or_let_in(page, text):
    lines, kinds = pages.page_lines(page)
    assert pages.main_text(lines, kinds) == text


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<a '>" * 200_000 + "<p>x", "</div>" * 150_000, "<div>" * 150_000,
                                  "<svg>" * 150_000, "<script " * 100_000, "<!--" * 200_000, '<p class="' * 90_000 + ">",
                                  "<div></p></section>" * 50_000])
def test_odd_markup_takes_linear_time(page):
    import time
    begin = time.process_time()
    pages.page_lines(page)
    assert time.process_time() - begin < 5


def test_many_equal_lines_are_aligned_in_bounded_memory():
    import time
    import tracemalloc
    same, begin = ["x"] * 30_000, time.process_time()
    tracemalloc.start()
    got = pages.shared_lines(["p", *same, "q", *same, "r"], ["s", *same, "t", "x", "u"])
    assert len(got) == 30_001 and tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()
    assert time.process_time() - begin < 20


def test_halving_gives_a_longest_common_subsequence(monkeypatch):
    rng = np.random.default_rng(2)
    for n in (40, 700):
        a, b = (rng.choice(list("abcd"), n).tolist() for _ in range(2))
        want = len(pages._by_matches(a, b, {x: [j for j, y in enumerate(b) if y == x] for x in set(b)}))
        assert pages._prefix_lengths(a, b)[-1] == want == len(pages.shared_lines(a * 1, b))
    a, b = (rng.choice(list("ab"), 3000).tolist() for _ in range(2))      # beyond 200,000 pairs
    places = sorted(pages.shared_lines(a, b))
    assert len(places) == pages._prefix_lengths(a, b)[-1]
    at = iter(b)
    assert all(a[i] in at for i in places)


def test_many_labels_take_memory_of_words_not_of_label_pairs():
    import tracemalloc
    rng = np.random.default_rng(1)
    scores, moves = rng.normal(size=(4000, 200)), rng.normal(size=(200, 200))
    tracemalloc.start()
    p = langid._marginals(scores, np.array([3000, 1, 999]), moves)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20 and np.allclose(p.sum(1), 1)
    tracemalloc.stop()
    words = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("ala", "elo", "imi", "oru", "uke")]
    samples = [(f"l{i:03d}", " ".join(rng.choice([f"{w}{i:03d}".translate(str.maketrans("0123456789", "abcdefghij"))
                                                  for w in words], 30))) for i in range(200)]
    model = langid.train(samples, rounds=2)
    assert model.weights.size <= 1 << 24 and len(model.labels) == 200


def test_training_sample_is_bounded_and_prefers_no_copy(spark):
    rows = [("a", "the same text")] * 400 + [("b", f"text {i}") for i in range(3000)] + [("c", "rare")]
    got = langid.training_sample(spark.createDataFrame(rows, "lang string, text string").repartition(4), 50)
    assert Counter(lab for lab, _ in got) == {"a": 1, "b": 50, "c": 1} and len(set(got)) == 52


def test_language_stage_keeps_texts_of_several_languages(spark, small_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = {}
    for r in docs.filter("lang is not null and length(text) between 400 and 900").orderBy("doc_id").collect():
        parts.setdefault(r.lang, r.text)
    mixed = " ".join(t[:400] for t in list(parts.values())[:3])
    one = spark.createDataFrame([(-5, mixed, None, "s", len(mixed), 3)], "doc_id long, text string, lang string, "
                                "source string, n_chars long, _ int")
    more = docs.withColumn("n_chars", F.col("n_chars").cast("long")).withColumn("_", F.lit(1)).unionByName(one)
    kept = corpus_pipeline.language(spark, more, None)
    assert kept.columns == more.columns and kept.filter("doc_id = -5 and _ = 3").count() == 1
    scored = langid.identify(more).filter("doc_id = -5").select("language.*").first()
    assert scored.score < 0.6 < scored.certainty


@pytest.mark.parametrize("name", ["op1_neighbours", "op2_mixing", "op6_simhash", "op11_lexical", "op12_hyperminhash",
                                  "op13_negatives"])
def test_nothing_is_left_in_the_scratch_folder(spark, small_dir, name):
    import os
    from tunelake.llm.common import staging
    from tunelake.session import checkpoint_root
    root = checkpoint_root(spark).replace("file:", "")
    before = set(os.listdir(root))
    with staging(spark):
        QUERIES[name](spark, small_dir).collect()
    assert set(os.listdir(root)) <= before
