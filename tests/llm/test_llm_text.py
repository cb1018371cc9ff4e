"""Quality rules, packing, mixing, near-duplicates and repeats against plain versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tunelake.llm import mixing, packing, quality, simhash, substrings, suffixes
from tunelake.llm.components import components
from tunelake.llm.queries import tokenizer_path


def key(row):
    return tuple((x is None, x) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_quality_measures(messy_docs, messy, no_docs):
    out = quality.quality(messy_docs)
    same(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words").collect(),
         [(r[0], *brute.quality(r[1])) for r in messy])
    assert out.filter("kept and base_failed").count() == 0
    assert out.filter((F.col("n_words") < 50) & F.col("kept")).count() == 0
    assert quality.quality(no_docs).count() == 0


def test_quality_is_one_projection(messy_docs):
    plan = quality.quality(messy_docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "hashpartitioning" not in plan


def test_rule_table(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 1.0)
    rule = quality.compile_rules((quality.Rule("x", 1, 3),), {"x": F.col("x")})
    assert [r[0] for r in df.filter(rule).select("id").collect()] == [1, 2, 3]


@pytest.mark.parametrize("n", [0, 1, 7, 1024, 1025, 5000])
def test_power_pieces(n):
    cut = packing.power_pieces(n, 1024)
    assert sum(k for _, k in cut) == n and all(k & (k - 1) == 0 and k <= 1024 for _, k in cut)
    assert [s for s, _ in cut] == [sum(k for _, k in cut[:i]) for i in range(len(cut))]


def test_packing_round_trip(messy_docs, messy, no_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    rows = packing.pack(messy_docs, tokenizer_path(), with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.offset == 0 and len(r.ids) == r.length == 1 << r.bucket for r in rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    by = defaultdict(Counter)
    for r in rows:
        by[r.doc_id][(r.start, tuple(r.ids), r.doc_tokens)] += 1
    want = defaultdict(Counter)
    for doc, text, *_ in messy:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        for s, k in packing.power_pieces(len(ids), 1024):
            want[doc][(s, tuple(ids[s:s + k]), len(ids))] += 1
    assert by == want
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_chunks_encode_like_the_tokenizer():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    odd = ["a\x1cb !\x1c c", "x  y   z\n\n w", "don't I'll 's 't", "<|endoftext|> a", "　漢字 x²3 ½",
           "  lead", "trail  ", "\r\n\t a", "é a\u0085b", "", " ", "a᠎b", "\U0001f600 ok", "é  x"]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.encode(odd, tokenizer_path())]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in odd]


def test_added_tokens_have_their_own_ids(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}  x", f"a  {end}\n\n{end} ", "<|endoftext|", "no token", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(list)
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += r.ids
    assert dict(got) == {i: tok.encode(t, add_special_tokens=False).ids + [0]
                         for i, t in enumerate(texts)}


def test_mixing_meets_weights(spark, no_docs):
    rows = [(i, "w " * (5 + i % 7), f"s{min(i % 10, 3)}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, target_entropy=1.99, max_repeats=None, block_docs=64).collect()
    taken, weight = Counter(), {}
    for r in out:
        taken[r.source] += r.mix_tokens
        weight[r.source] = r.mix_weight
    assert abs(-sum(w * math.log2(w) for w in weight.values()) - 1.99) < 1e-4
    budget = sum(5 + i % 7 for i in range(2000))
    for s, w in weight.items():      # the last document taken may pass the budget
        assert 0 <= taken[s] - w * budget < 12
    copies = Counter((r.doc_id, r.mix_epoch) for r in out)
    assert set(copies.values()) == {1}
    for s in weight:                 # whole epochs before the last
        each = Counter(r.doc_id for r in out if r.source == s)
        assert max(each.values()) - min(each[d] for d, _, x in rows if x == s) <= 1
    assert mixing.mix(no_docs).count() == 0


def test_mixing_repeat_limit_and_order(spark):
    docs = spark.createDataFrame([(i, "a b c d", "big" if i else "small") for i in range(64)],
                                 "doc_id long, text string, source string")
    out = mixing.mix(docs, target_entropy=None, max_repeats=3.0).collect()
    small = [r for r in out if r.source == "small"]
    assert len(small) in (3, 4) and abs(small[0].mix_weight * 64 - 3) < 0.01
    again = mixing.mix(docs.repartition(5), target_entropy=None, max_repeats=3.0).collect()
    same(again, [tuple(r) for r in out])
    assert not [c for c in ("Python",) if c in mixing.mix(docs)._jdf.queryExecution().toString()]


def test_mixing_is_never_steeper_than_the_sources(spark):
    """20 sources have more than the default entropy: every row is taken once."""
    docs = spark.createDataFrame([(i, "w " * (3 + i % 20), f"s{i % 20}") for i in range(400)],
                                 "doc_id long, text string, source string")
    out = mixing.mix(docs, block_docs=4).collect()
    assert Counter(r.doc_id for r in out) == Counter(range(400))
    total = 20 * sum(range(3, 23))
    assert all(abs(r.mix_weight - 20 * r.mix_tokens / total) < 1e-9 for r in out)


def test_mixing_repeat_limit_holds_for_any_budget(spark):
    docs = spark.createDataFrame([(i, "a b c d", "big" if i > 3 else "small") for i in range(64)],
                                 "doc_id long, text string, source string")
    for target in (None, 0.01, 4.0):
        out = mixing.mix(docs, target_entropy=target, max_repeats=2.0, budget=64 * 4 * 3.0).collect()
        assert Counter(Counter(r.doc_id for r in out).values()) == {2: 64}


def test_mixing_messy(messy_docs):
    out = mixing.mix(messy_docs, target_entropy=1.5)
    assert set(messy_docs.columns) - {"mix_tokens"} <= set(out.columns)
    assert out.filter("source is null").count() > 0


def test_simhash_components(messy_docs, messy, no_docs):
    want = [(r[0], brute.simhash(r[1])) for r in messy]
    reach = brute.near_components(want, 4)
    out = simhash.near_duplicates(messy_docs)
    same(out.select("doc_id", "fingerprint", "component_id").collect(),
         [(d, f"{f:016x}", c) for (d, f), c in zip(want, reach)])
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("segments,block", [(3, 1024), (2, 1024), (4, 1024), (3, 4)])
def test_multi_index_finds_all_links(spark, segments, block):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 20)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            x = int(c) ^ sum(1 << int(b) for b in flips)
            fps.add(x - (1 << 64) if x >= 1 << 63 else x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in components(simhash.links(df, 4, segments, block)).collect()}
    rows = [(f, f & (2**64 - 1)) for f in fps]
    want = dict(zip(fps, brute.near_components(rows, 4)))
    assert {f: got.get(f, f) for f in fps} == want


def test_long_chain_of_components(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.limit(0)).count() == 0


def test_passages(messy_docs, messy, no_docs):
    out = substrings.remove_repeats(messy_docs)
    same(out.select("doc_id", "repeats.n_words", "repeats.n_removed", "repeats.kept_sha256").collect(),
         brute.passages([r[:2] for r in messy]))
    assert substrings.remove_repeats(no_docs).count() == 0


def test_passages_kept_text(spark):
    run = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, run), (2, f"x {run} y"), (3, "no repeat here")],
                                 "doc_id long, text string")
    out = {r.doc_id: r.repeats.kept_text
           for r in substrings.remove_repeats(docs, with_text=True).collect()}
    assert out == {1: None, 2: "x y", 3: None}


@pytest.mark.parametrize("group", [50_000, 1])
def test_byte_repeats(messy_docs, messy, no_docs, group):
    short = [(r[0], r[1][:3000] if r[1] else r[1]) for r in messy]
    docs = messy_docs.withColumn("text", F.substring("text", 1, 3000))
    out = suffixes.remove_repeats(docs, length=60, k=16, group=group)
    same(out.select("doc_id", "repeats.n_bytes", "repeats.n_removed", "repeats.n_spans",
                    "repeats.kept_sha256").collect(), brute.byte_repeats(short, 60))
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_long_text_in_blocks(spark, monkeypatch):
    """Overlapping blocks of a long text lose nothing at their edges."""
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh"), 5000))
    text += text[1200:2100]
    assert [len(s[2]) for s in suffixes._segments([text], 200)] == [len(text)]
    monkeypatch.setattr(suffixes, "_BLOCK", 512)
    whole = suffixes._segments([text], 200)
    assert len(whole) > 5 and all(raw == text[lo:lo + len(raw)].encode() for _, lo, raw in whole)
    starts = [(lo, lo + len(raw) - 199) for _, lo, raw in whole]
    assert starts[0][0] == 0 and starts[-1][1] == len(text) - 199
    assert all(a[1] == b[0] for a, b in zip(starts, starts[1:]))


def test_repeat_groups_hold_all_occurrences():
    lefts = [b"cba", b"cbx", b"cba", b"zzz"]
    rights = [b"seed12", b"seed12", b"seed19", b"seed12"]
    got = {(a, b, tuple(sorted(g))) for a, b, g in suffixes.repeat_groups(lefts, rights, 7)}
    assert got == {(2, 6, (0, 1)), (3, 5, (0, 2)), (2, 5, (0, 1, 2))}


@pytest.mark.parametrize("doc", [5, None])
def test_rows_whose_short_hashes_collide_keep_their_own_words(spark, doc):
    """Two texts of one id (or of none) with equal 32-bit hashes: only one of them repeats anything."""
    rng = np.random.default_rng(8)
    shared = " ".join(f"w{i}" for i in rng.integers(0, 10 ** 6, 60))
    base = spark.range(400_000).select(
        "id", F.when(F.col("id") % 2 == 0, F.concat(F.lit(shared + " x"), "id"))
        .otherwise(F.concat(F.lit("alone " * 3), F.repeat(F.concat(F.lit("y"), "id", F.lit(" ")), 60))).alias("text"))
    hit = (base.filter("id % 2 = 0").select(F.hash("text").alias("h"), F.col("text").alias("a"))
           .join(base.filter("id % 2 = 1").select(F.hash("text").alias("h"), F.col("text").alias("b")), "h")
           .first())
    assert hit is not None
    rows = [(1, shared), (doc, hit.a), (doc, hit.b), (doc, hit.b), (7, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = substrings.remove_repeats(docs).select("doc_id", "repeats.n_words", "repeats.n_removed",
                                                 "repeats.kept_sha256")
    same(got.collect(), brute.passages(rows))
    got = suffixes.remove_repeats(docs).select("doc_id", "repeats.n_bytes", "repeats.n_removed",
                                               "repeats.n_spans", "repeats.kept_sha256")
    same(got.collect(), brute.byte_repeats(rows, 200))


def test_mixing_against_a_plain_version(spark):
    """Weights by a fine search over exponents; each source's last epoch is cut where its quota is met."""
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 9)), f"s{min(int(rng.exponential(2)), 6)}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, entropy_share=0.98, max_repeats=3.0, budget_ratio=1.25, block_docs=32).collect()
    tokens = Counter()
    for _, text, s in rows:
        tokens[s] += len(text.split())
    total = sum(tokens.values())
    share = np.array([tokens[s] / total for s in sorted(tokens)])
    best = None
    for a in np.linspace(0, 1, 200_001):
        w = share ** a / (share ** a).sum()
        if -(w * np.log2(w)).sum() <= 0.98 * math.log2(len(share)) and (w / share * 1.25).max() <= 3:
            best = w
            break
    weight = {r.source: r.mix_weight for r in out}
    assert 0.01 < abs(best - share).max() and np.allclose([weight[s] for s in sorted(tokens)], best, atol=1e-4)
    # a whole epoch more gives the order of all rows in the epoch that was cut
    full = mixing.mix(docs, target_entropy=None, max_repeats=None, budget=20.0 * total, block_docs=32).collect()
    order = {(r.source, r.mix_epoch, r.doc_id): (r.mix_rank.block, r.mix_rank.doc) for r in full}
    for s in tokens:
        quota = 1.25 * total * weight[s]
        whole = int(quota // tokens[s])
        taken = Counter(r.doc_id for r in out if r.source == s)
        ids = sorted((d for d, _, x in rows if x == s), key=lambda d: order[s, whole, d])
        room, cut = quota - whole * tokens[s], set()
        for d in ids:
            if room <= 0:
                break
            cut.add(d)
            room -= len(rows[d][1].split())
        assert taken == Counter({d: whole + (d in cut) for d in ids if whole + (d in cut)})
        ranks = [(r.mix_epoch, r.mix_rank.block, r.mix_rank.doc) for r in out if r.source == s]
        assert len(set(ranks)) == len(ranks)
