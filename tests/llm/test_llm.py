"""Each operator against a brute-force version, on hand-made rows that hold the awkward cases."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("hourledger.llm.queries")

from pyspark.sql import functions as F

import corpus_pipeline
from hourledger.llm import chat, languages, lm, ngram_join, toxicity, url_filter
from hourledger.llm.arrow import blocks
from hourledger.llm.bpe import Encoder, encode_decode, load_spec
from hourledger.llm.decontaminate import contamination
from hourledger.llm.languages import fit_languages, identify
from hourledger.llm.queries import tokenizer_path
from hourledger.llm.token_counts import Transducer, count_tokens, load_pieces
from hourledger.llm.topk import top_k
from hourledger.llm.words import FACTOR, mix, words_and_endings

DOCS = "doc_id long, text string, n_tokens string, score int, lang string"


def awkward_texts():
    rng = random.Random(3)
    letters = "abcdeéthnSß,.\n'▁日🙂сл0123!?́  \t"
    texts = [None, "", " ", "\n\t ", "a", "A a", "x\0y", "Σας ΑΣ", "I'll WE'VE", "<|startoftext|> <s> <unk> <|endoftext|>", "a  b   c", "the the the"]
    texts += ["日本語テキスト" * 400, "a" * 5000, "ab " * 4000, "\x1c a\x1db \x85 c\u200bd\u00a0e", "\\n\\\\# :<"]
    return texts + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 900))) for _ in range(60)] + ["same text of some words"] * 3


def frame(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "x", 7, "en") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, awkward_texts()).repartition(3)


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


def test_token_counts_are_the_library_s(docs):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_id(count_tokens(docs, path, limit=100))
    for i, text in enumerate(awkward_texts()):
        want = len(model.encode(text or "", num_threads=1))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), want, want > 100)


def test_transducer_that_forgets_counts_alike():
    pieces = load_pieces(tokenizer_path("piece_bpe_32k.model"))
    small, large = Transducer(pieces, max_cells=1000), Transducer(pieces)
    from hourledger.llm.arrow import text_bytes
    import pyarrow as pa

    for texts in (awkward_texts(), awkward_texts()[::-1]):
        block = text_bytes(pa.array(texts, pa.string()))
        assert small.count(*block).tolist() == large.count(*block).tolist()


def test_bpe_is_the_library_s_and_decodes(docs):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got, digests = by_id(encode_decode(docs, path)), by_id(encode_decode(docs, path, digest=True))
    for i, text in enumerate(awkward_texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].decoded == decoded and got[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_remembers_a_bounded_number_of_bytes():
    encoder = Encoder(load_spec(tokenizer_path("word_bpe_49k.json")))
    block = lambda k: [" ".join("a" * 1000 + str(k * 1000 + n) for n in range(1000))]
    first = list(encoder.run(block(0)))
    most = 0
    for k in range(1, 40):
        list(encoder.run(block(k)))
        most = max(most, sum(len(c) + len(ids) + len(text) for c, (ids, text) in encoder.known.items()))
    assert most < 64 << 20
    assert list(encoder.run(block(0))) == first


def test_languages(spark):
    rows = [("the cat and the dog", "en"), ("und der hund ist", "de"), ("le chat et la", "fr")] * 20 + [(None, "en"), ("xyz", None), ("", "de")]
    train = spark.createDataFrame([(i, t, None, 1, lang) for i, (t, lang) in enumerate(rows)], DOCS)
    model = fit_languages(train)
    assert model.languages == ["de", "en", "fr"]
    got = by_id(identify(frame(spark, ["the dog", "der hund", "la chat", None, "", "123 !?", "the dog"]), model))
    assert [got[i].lang_pred for i in range(7)] == ["en", "de", "fr", "und", "und", "und", "en"]
    assert all(0 <= row.score <= 1 for row in got.values()) and got[3].score == 0 and got[0].score == got[6].score
    marks = by_id(identify(frame(spark, ["\u0301", "12 \u20dd", "\u0301\u0302!", "e\u0301"]), model))
    assert [marks[i].lang_pred == "und" for i in range(4)] == [True, True, True, False]
    nobody = fit_languages(train.where("false"))
    assert {row.lang_pred for row in identify(train, nobody).collect()} == {"und"}


def test_language_posteriors_are_those_of_counting_grams(spark):
    """Grams of words and spaces as text, counted one by one; no two of these share a hash."""
    import math

    rng = random.Random(6)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(8))
    train = [(make("aab"), "x") for _ in range(15)] + [(make("abb"), "y") for _ in range(9)]
    asked = [make("ab") for _ in range(10)] + ["", "a"]

    def grams(text):
        for n in languages.GRAMS:
            for k in range(len(text) - n + 1):
                if text[k : k + n].strip():
                    yield text[k : k + n]

    counts = {lang: Counter(g for t, own in train if own == lang for g in grams(t)) for lang in "xy"}
    space = 1 << languages.FEATURE_BITS
    got = by_id(identify(frame(spark, asked), fit_languages(spark.createDataFrame([(i, t, None, 1, lang) for i, (t, lang) in enumerate(train)], DOCS))))
    for i, text in enumerate(asked):
        rows = {lang: sum(own == lang for _, own in train) + 1 for lang in "xy"}
        log = {
            lang: math.log(rows[lang] / sum(rows.values()))
            + sum(math.log((counts[lang][g] + languages.SMOOTHING) / (counts[lang].total() + languages.SMOOTHING * space)) for g in grams(text))
            for lang in "xy"
        }
        best = max("xy", key=log.get)
        assert got[i].lang_pred == (best if text else "und")
        assert got[i].score == (pytest.approx(1 / (1 + math.exp(min(log.values()) - max(log.values()))), abs=1e-4) if text else 0)


def test_languages_held_out(spark):
    from hourledger.llm.queries import op6_language_id

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in op6_language_id(spark, sf).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def brute_groups(texts, k, percent):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sets, [find(i) for i in range(len(sets))]


def near_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = awkward_texts()
    for length in (4, 11, 15, 25, 60, 150):
        base = [word() for _ in range(length)]
        for edits in (0, 0, 1, 1, 1, 2, 3, 5, 9):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(length)] = word()
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_near_groups_are_those_of_all_pairs(spark, monkeypatch, k, percent):
    if k == 5:  # several blocks to a group; tasks get the value by pickling the module
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 100)
    texts = near_texts()
    sets, roots = brute_groups(texts, k, percent)
    got = by_id(ngram_join.near_groups(frame(spark, texts).repartition(4), k, percent))
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == roots


@pytest.mark.parametrize("boundary", [0, 30, 10**6])
def test_small_and_large_sets_give_the_same_links(spark, monkeypatch, boundary):
    monkeypatch.setattr(ngram_join, "small_boundary", lambda *_: boundary)
    texts = [t for t in near_texts() if t is None or len(t.split()) < 120]
    _, roots = brute_groups(texts, 3, 90)
    got = by_id(ngram_join.near_groups(frame(spark, texts), 3, 90))
    assert [got[i].component_id for i in range(len(texts))] == roots


def test_near_groups_of_repeated_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None), (3, "a b c d"), (2, "x y z w")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in ngram_join.near_groups(df).collect())
    assert got == [(-1, 2, -1), (1, 2, 1), (1, 2, 1), (2, 0, 2), (2, 2, 2), (3, 2, 1)]
    assert ngram_join.near_groups(df.where("false")).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in ngram_join.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 200: 100, 300: 100}


def brute_contamination(texts, items, size=13):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for name, text in items:
        own = words(text)
        for i in range(max(1, len(own) - size + 1) if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(str(name))
    for text in texts:
        own, hit, found = words(text), set(), set()
        for window, names in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= names
        yield len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)


def test_contamination_is_that_of_all_places(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)] + ["É", "é2", "Big"]
    item = " ".join(rng.choice(words) for _ in range(20))
    items = [(1, item), (2, "short One"), (3, None), (4, "... !"), (10, item), (5, "w1 " * 14), (6, "never seen here")]
    texts = [*awkward_texts()[:17], item, item.upper(), "x, " + item.replace(" ", "--") + " y", " ".join(item.split()[2:17]), "short one", "w1 " * 40, "a b c short; one d " * 3, item + " " + "z " * 2000]
    texts += [" ".join(rng.choice(words) for _ in range(200)) for _ in range(5)] + [item]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("word", F.lit(1))
    got = by_id(contamination(frame(spark, texts).repartition(3), benchmark))
    for i, (n_words, n_hit, found, dirty) in enumerate(brute_contamination(texts, items)):
        row = got[i]
        assert (row.n_words, row.n_hit, row.n_items, row["items"], row.contaminated) == (n_words, n_hit, len(found), found, dirty)
        assert row.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert {r.n_hit for r in contamination(frame(spark, texts), benchmark.where("false")).collect()} == {0}
    assert contamination(frame(spark, texts).where("false"), benchmark).count() == 0


def test_contamination_without_broadcast(spark, monkeypatch):
    from hourledger.llm import decontaminate

    items = spark.createDataFrame([(1, "a b c"), (2, "c d")], "item_id long, text string")
    texts = ["x a b c d", "c d c d", None, "a b d", "c d c d"]
    want = sorted(map(repr, contamination(frame(spark, texts), items).collect()))
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    assert sorted(map(repr, contamination(frame(spark, texts), items).collect())) == want


def test_decontamination_runs_no_python(spark, docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_urls(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    cases = {
        "http://A.Example.COM/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/1#f": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "x://b.com": ("b.com", "", None, "allow"),
        "x://net/es/": ("net", "/es/", "net/es/", "block"),
        "x://planet/es/": ("planet", "/es/", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://a/b://c": ("a", "/b://c", None, "allow"),
        "http://h?://x": ("h", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(100 + i, f"http://spam.org/{'ads' if i % 2 else 'ok'}/{i}.html") for i in range(80)]
    labels = spark.createDataFrame([(100 + i, bool(i % 2)) for i in range(80) if i < 30 or not i % 2] + [(None, True)], "page_id long, bad boolean")
    pages = spark.createDataFrame([(i, u, "t", "v") for i, u in rows], "page_id long, url string, template string, verdict string")
    got = by_id(url_filter.filter_urls(pages.unionAll(pages.where("page_id = 0")), labels, rules), "page_id")
    for i, want in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want
    assert got[101].template == "/ads/{n}.html" and got[100].template == "/ok/{n}.html"
    assert all(got[100 + i].verdict == ("block" if i % 2 else "allow") for i in range(80))
    assert url_filter.filter_urls(pages.where("false"), labels.where("false"), rules).count() == 0


def brute_templates(rows):
    """Templates of (host, path) pages, each node's pages looked at by themselves."""
    import re

    def wildcard(x):
        extension = (re.search(r"\.[^\W\d_]{1,4}$", x) or [""])[0]
        stem = x[: len(x) - len(extension)]
        return "".join("{w}" if m[1] else "{n}" if m[2] else m[0] for m in re.finditer(r"([^\W\d_]+)|(\d+)|.", stem, re.S)) + extension

    out = [""] * len(rows)
    nodes = {host: [k for k, r in enumerate(rows) if r[0] == host] for host, _ in rows}
    work = [(members, 0) for members in nodes.values()]
    while work:
        members, level = work.pop()
        parts = {k: rows[k][1].removeprefix("/").split("/") for k in members}
        deeper = [k for k in members if len(parts[k]) > level]
        counts, children = Counter(parts[k][level] for k in deeper), {}
        for k in deeper:
            x = parts[k][level]
            step = x if counts[x] >= max(2, len(deeper) * url_filter.LITERAL_SHARE) else wildcard(x)
            out[k] += "/" + step
            children.setdefault(step, []).append(k)
        work += [(own, level + 1) for own in children.values()]
    return out


def test_templates_are_those_of_looking_at_each_node(spark):
    rng = random.Random(31)
    parts = ["news", "a1", "img", "x.html", "2024", "05", "über", "", "q-7_z"]
    rows = []
    for host in ("one", "two", ""):
        for _ in range(120):
            path = "/".join(rng.choice(parts) if rng.random() < 0.7 else f"{rng.choice('abcd')}{rng.randrange(99)}" for _ in range(rng.randint(0, 5)))
            rows.append((host, "/" + path if path else ""))
    rows += [("long", "/" + "/".join(f"s{i}" for i in range(60)))] * 3 + [("long", "/t/" + "/".join(f"s{i}" for i in range(40)))]
    rows += [("deep", f"/a/b/c/d/e/f/{'good' if i % 2 else 'bad'}/{i}") for i in range(60)]
    rows += [("short", f"/{rng.choice('bcdf')}{a}{b}{rng.choice('aeiou')}") for a in "aeiou" for b in "klmnprst"]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id int, host string, path string").repartition(4)
    got = by_id(url_filter.templates(df), "page_id")
    want = brute_templates(rows)
    assert [got[i].template for i in range(len(rows))] == want
    assert {t for (h, _), t in zip(rows, want, strict=True) if h == "short"} == {"/{w}"}


def test_pages_that_differ_far_down_are_told_apart(spark):
    pages = spark.createDataFrame([(i, f"http://h/a/b/c/d/e/f/{'good' if i % 2 else 'poor'}/{i}") for i in range(200)], "page_id int, url string")
    labels = spark.createDataFrame([(i, i % 2 == 0) for i in range(200)], "page_id int, bad boolean")
    got = url_filter.filter_urls(pages, labels, []).collect()
    assert all(r.verdict == ("allow" if r.page_id % 2 else "block") for r in got)


def test_url_branches_of_a_dense_range_of_shares(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("h", f"/{letters[i // 26]}{letters[i % 26]}", j < 5 * i) for i in range(41) for j in range(200)]
    rows += [("few", f"/s{i}", j * 11 < 30 * i) for i in range(12) for j in range(30)]
    rows += [("deep", "/bad/{n}/x", True)] * 40 + [("deep", "/good/{n}/x", False)] * 40 + [("deep", "/bad/{n}/y", None), ("deep", "/bad", None), ("deep", "/good", None)]
    rows += [("ends", "/a", True)] * 40 + [("ends", "/a/b", False)] * 40 + [("unknown", "", None)]
    got = {(r.host, r.template): r for r in url_filter.branches(spark.createDataFrame(rows, "host string, template string, bad boolean").repartition(5)).collect()}
    assert len(got) == len({r[:2] for r in rows})
    for (host, _), r in got.items():
        if host in ("h", "few"):
            assert abs(r.bad_share - r.bad / r.n) < (0.12 if host == "h" else 0.3)
    assert got["few", "/s0"].bad_share < 0.2 and got["few", "/s11"].bad_share > 0.8
    # Without labels of its own a template has the share of the nearest node that has some.
    assert got["deep", "/bad/{n}/y"].bad_share > 0.9 > 0.1 > got["deep", "/good"].bad_share
    assert got["ends", "/a"].bad_share > 0.9 and got["ends", "/a/b"].bad_share < 0.1
    assert got["unknown", ""].bad_share == pytest.approx(sum(bool(r[2]) for r in rows) / sum(r[2] is not None for r in rows), abs=0.01)


def exact_top(rows, k):
    """By whole numbers of any size; rows of (id, vector)."""
    import math

    x = [(i, [math.floor(64 * float(c)) for c in v]) for i, v in rows]
    out = set()
    for q, v in {i: v for i, v in reversed(x) if i % 20 == 0}.items():
        scored = [(-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in x if i != q]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("pivots", [0, 3, 32])
def test_top_k_with_ties_and_numbers_of_any_size(spark, monkeypatch, pivots):
    from hourledger.llm import topk

    monkeypatch.setattr(topk, "PIVOTS", pivots)
    rng = random.Random(9)
    rows = [(i, [rng.choice([0.0, 0.5, -1.0]) for _ in range(3)]) for i in range(300)]
    rows += [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([6, 9, 12]), rng.uniform(-1, 1), 2.0]) for i in range(300, 340)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect()} == exact_top(rows, 7)


def test_top_k_of_components_beyond_long_ends(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 1.0]), (2, [3e38, 0.0]), (3, [0.25, 0.5]), (20, [1.0, 1.0])]
    got = {tuple(r) for r in top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3).collect()}
    assert got == exact_top(rows, 3)


def test_top_k_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0])] * 30 + [(n, [float(n % 5), 1.0]) for n in range(1, 45)] + [(7, [9.0, 9.0])] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0, k=5).collect())
    assert got == sorted(exact_top(rows, 5))


def test_top_k_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(60)]
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, []), (420, [-0.01] * 8), (440, [0.5] * 3)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    usable = {i: np.pad(np.floor(64 * np.array(v)), (0, 8 - len(v))) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in usable:
        if q % 20 == 0:
            best = sorted((-int(usable[q] @ x), i) for i, x in usable.items() if i != q)[:20]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0).collect()} == want
    few = df.where("vec_id in (0, 1, 2)")
    assert top_k(few, F.col("vec_id") == 0).count() == 2
    assert top_k(df.where("false"), F.lit(True)).count() == 0


def test_chat_reads_back(spark):
    texts = [t if t is None else t[:300] for t in awkward_texts()] + [r"\### Assistant: </turn> ok", "### user: x </turn>\n### assistant: y </turn>", "<|image|>"]
    rows = [(i // 4, i % 4, ["user", "assistant", "a:b\n#", None][i % 4], t, "x") for i, t in enumerate(texts)] + [(-1, None, "assistant", "first", "x"), (-1, 1, "user", "second", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_conversations(df.withColumn("parts", F.array(chat.text_part(F.col("text")))))
    got = by_id(chat.conversation_digests(formatted), "conv_id")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        row = got[conv]
        assert (row.n_turns, row.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert "Python" not in formatted._jdf.queryExecution().executedPlan().toString()


def test_chat_attachments(spark):
    parts = [("text", "see <this>", None, None), ("image", None, "s3://a.png", None), ("text", " and ", None, None), ("audio", None, "b.wav", 9)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("document", None, None, None), ("text", "ok", None, None)]), (1, 2, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_conversations(df).first()
    assert row.formatted == "### user: see \\lthis><|image|> and <|audio|> </turn>\n### assistant: <|document|>ok </turn>\n### user:  </turn>\n"
    assert [tuple(a) for a in row.attachments] == [(0, "image", "s3://a.png", 256), (0, "audio", "b.wav", 9), (1, "document", None, 512)]
    read = chat.format_conversations(df).select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l")).first()
    assert [tuple(t) for t in read.t] == [("user", "see <this> and "), ("assistant", "ok"), ("user", "")] and read.l == "ok"
    assert chat.format_conversations(df.where("false")).count() == 0


def test_toxicity(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts, toxic = [], []
    for i in range(240):
        bad = i % 4 == 0
        texts.append(" ".join([word() for _ in range(30)] + (["nasty" + word()[:2], "Vilest"] if bad else ["kind"])))
        toxic.append(int(bad))
    docs = frame(spark, [*texts, None, "", "nasty", "VILEST!", "nothing known"])
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if i % 5] + [(0, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    fitted = toxicity.fit_toxicity(docs, labels)
    got = by_id(toxicity.score_toxicity(docs, fitted))
    assert [got[i].predicted for i in range(240)] == toxic
    assert [got[i].predicted for i in range(240, 245)] == [0, 0, 1, 1, 0] and got[243].evidence and not got[240].evidence
    assert all(0 <= r.score <= 1 for r in got.values())
    index = toxicity.Index(**fitted)
    for text in texts[:40]:  # the search is exact
        found = index.vocabulary.find(text)
        if found:
            at, weight = toxicity.unit_vector(found, index.idf)
            own = dict(zip(at.tolist(), weight, strict=True))
            every = []
            for _, _, other in fitted["examples"]:
                a, w = toxicity.unit_vector(other, index.idf)
                every.append(sum(own.get(i, 0) * x for i, x in zip(a.tolist(), w, strict=True)))
            places, cosines = index.nearest(found)
            one_each = np.repeat(cosines, index.size[places])
            assert np.allclose(one_each[: toxicity.K], sorted((c for c in every if c > 0), reverse=True)[: toxicity.K])
            assert np.isclose(index.votes(cosines, index.size[places]).sum(), min(toxicity.K, len(one_each)))
            assert index.score(found) == index.score(found) and len(index.score(found)[1]) == min(toxicity.K, len(one_each))
    assert {r.predicted for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels.where("false"))).collect()} == {1}


def test_lm_scores(spark):
    texts = awkward_texts() + ["the cat sat on the mat", "the dog sat on the rug"] * 30
    docs = frame(spark, texts).repartition(3)
    train = docs.where(F.crc32(F.col("doc_id").cast("string")) % 10 != 0)
    fitted = lm.fit_lm(train)
    got = by_id(lm.score_lm(docs, fitted))
    tokens = [(t or "").encode().lower().split() + [b" "] for t in texts]
    counts = Counter(w for i, own in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10 for w in own)
    total, kinds = sum(counts.values()), len(counts)
    for i, own in enumerate(tokens):
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(own), sum(w in counts for w in own), total)
        assert got[i].base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    model = lm.Model(fitted["flat"])
    every = np.arange(lm.UNITS)
    for one, two in ((lm.END, lm.END), (0, 3)):  # a distribution over all units
        p = np.exp(model.log_probabilities(np.full(lm.UNITS, one), np.full(lm.UNITS, two), every))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    assert lm.score_lm(docs.where("false"), fitted).count() == 0


@pytest.mark.parametrize("steep", [1.0, 90.0])
def test_lm_probabilities_are_normalised_at_any_scale(steep):
    draw = np.random.default_rng(5)
    model = lm.Model(draw.normal(0, 1, sum(int(np.prod(s)) for s in lm.Model.SHAPES)) * steep)
    context, vector, place, bias = (p.astype(np.float64) for p in model.parts)
    one, two, target = draw.integers(0, lm.UNITS, (3, 500)).astype(np.int16)
    one[250:], two[250:] = one[:250], two[:250]
    score = (context[one] * place[0] + context[two] * place[1]) @ vector.T + bias
    top = score.max(axis=1)
    want = score[np.arange(500), target] - top - np.log(np.exp(score - top[:, None]).sum(axis=1))
    got = model.log_probabilities(one, two, target)
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4 * steep**3)


def test_words_are_hashed_in_little_room():
    """Work by byte is done on pieces that stay in the processor's cache; a word's hash is the polynomial of its bytes."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcXYZé") for _ in range(rng.randint(1, 9))) for _ in range(700_000)]
    text = pa.array([" ".join(words)])
    tracemalloc.start()
    hashes, endings, begins = words_and_endings(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * len(text[0].as_py().encode())
    assert begins.tolist() == [0, len(words)]
    for i in [0, 1, len(words) // 2, len(words) - 1]:
        low = "".join(c.lower() if c.isascii() else c for c in words[i]).encode()
        plain = sum((b + 1) * pow(FACTOR, k, 1 << 64) for k, b in enumerate(low)) % (1 << 64)
        assert hashes[i] == mix(np.array([plain], np.uint64))[0]
        assert endings[i] == int.from_bytes(bytes(reversed(low[-3:])).ljust(3, b"\0"), "big")


def test_lm_joins_what_is_not_broadcast(spark, monkeypatch):
    docs = frame(spark, ["a b c d e f g h a b a", "a b zz", None, "q q"])
    want = by_id(lm.score_lm(docs, lm.fit_lm(docs.where("doc_id <> 3"))))
    monkeypatch.setattr(lm, "FREQUENT", 3)
    got = by_id(lm.score_lm(docs, lm.fit_lm(docs.where("doc_id <> 3"))))
    assert all(got[i].base_score == pytest.approx(want[i].base_score) and got[i].n_known == want[i].n_known for i in range(4))


def test_near_duplicate_stage_decides_by_text_not_by_id(spark):
    words = [f"w{i}" for i in range(60)]
    same, near, other = " ".join(words), " ".join([*words, "z"]), " ".join(reversed(words))
    rows = [(1, same, "a"), (2, near, "b"), (2, None, "c"), (2, "", "d"), (3, same, "e"), (3, other, "f"), (3, other, "f"), (3, None, "g"), (None, same, "h"), (None, same, "h"), (4, "... two words", "i"), (4, "... two words", "j")]
    docs = spark.createDataFrame([(*r, {"x": 1}) for r in rows], "doc_id long, text string, lang string, extra map<string, int>").repartition(3)
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, r.text or "", r.lang if r.doc_id != 4 else "one") for r in kept.collect())
    assert got == sorted([(1, same, "a"), (2, "", "c"), (2, "", "d"), (3, other, "f"), (3, "", "g"), (-1, same, "h"), (-1, same, "h"), (4, "... two words", "one")])


@pytest.mark.parametrize("shingles", [40, 150, 10_000])
def test_chains_of_links_through_many_blocks(spark, monkeypatch, shingles):
    """Each text is linked to its neighbours in the chain only; stars of copies hang on some."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[2 * i : 2 * i + 60]) for i in range(45)] + [" ".join(words[200 + 3 * i : 260 + 3 * i]) for i in range(12)]
    texts += [texts[20] + f" x{i}" for i in range(15)]
    random.Random(3).shuffle(texts)
    got = by_id(ngram_join.near_groups(frame(spark, texts).repartition(5), 3, 85))
    _, roots = brute_groups(texts, 3, 85)
    assert len(set(roots)) < len(texts) / 3 and [got[i].component_id for i in range(len(texts))] == roots


def test_signatures_of_any_width_keep_links_and_part_large_sets():
    """Sets that share nearly all are candidates, also where one has more bins; large unrelated sets are not."""
    draw = np.random.default_rng(7)

    def signature(values):
        wide = int(ngram_join.bins_of(np.array([len(values)]))[0])
        return np.minimum(np.bincount(values % wide, minlength=wide), ngram_join.FULL).astype(np.uint8).tobytes()

    for size in (60, 1000, 1024, 1100, 2048, 2300, 8000, 20_000):
        own = draw.choice(1 << 40, size, replace=False)
        fewer, other = own[: -(-size * 9 // 10)], np.concatenate([own[: -(-size * 19 // 20)], draw.choice(1 << 40, size // 20)])
        values = [fewer, own, other]
        if size >= 1000:
            values += [draw.choice(1 << 40, size - 3 * i, replace=False) for i in range(4)]
        draw.shuffle(order := np.arange(len(values)))
        found = ngram_join.candidates_of(np.array([len(values[i]) for i in order]), [signature(values[i]) for i in order], 80)
        assert len(found) == 2 and {int(order[i]) for pair in found for i in pair} == {0, 1, 2}


def test_large_texts_that_share_a_passage_are_no_group(spark, monkeypatch):
    """Groups of large sets chained by little in common were dealt out pair of blocks by pair of blocks."""
    monkeypatch.setattr(ngram_join, "SKETCH_BITS", 1)  # as full as the sketch of a large corpus: rarity tells nothing
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = [word() for _ in range(300)]
    texts = [" ".join([word() for _ in range(3700 + 9 * i)] + passage) for i in range(10)]
    texts += [texts[0] + " more words", texts[4].replace(" ", "\n")]
    scanned, scan = [], ngram_join._scan

    def spy(texts, nodes, groups, k, percent):
        scanned.extend(groups.collect())
        return scan(texts, nodes, groups, k, percent)

    monkeypatch.setattr(ngram_join, "_scan", spy)
    got = by_id(ngram_join.near_groups(frame(spark, texts).repartition(3), 5, 80))
    assert [got[i].component_id for i in range(12)] == [*range(10), 0, 4]
    assert sorted(r["id"] for r in scanned) == [0, 10]


def test_counters_that_are_full_keep_links(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FULL", 2)
    rng = random.Random(21)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(30, 60))) for _ in range(12)]
    texts += [t + " q" for t in texts[:6]] + texts[:3]
    got = by_id(ngram_join.near_groups(frame(spark, texts).repartition(4), 3, 80))
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    assert [got[i].component_id for i in range(len(texts))] == root


def test_pipeline_stages(spark, tmp_path):
    from hourledger.llm.languages import UNKNOWN

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.unionByName(extra).withColumn("score", F.lit(1)).withColumn("lang_pred", F.lit(UNKNOWN))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        if k == 2:
            texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
            _, roots = brute_groups([t for _, t in texts], 5, 80)
            want = {i for (i, _), n, root in zip(texts, range(len(texts)), roots, strict=True) if n == root}
            assert {r.doc_id for r in kept.collect()} == want
        path = f"{tmp_path}/{k}"
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
    assert 0 < corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0
    again = docs.unionAll(docs)
    assert corpus_pipeline.STAGES[2][1](spark, again, sf).count() == docs.count()


def test_stages_bound_the_bytes_of_a_batch(spark):
    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    rows = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('ein Wort ', 2000)").alias("text"), F.lit("de").alias("lang"))
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(limit)
        stage(spark, rows.where("false"), "/root/testdata/sf0.001")
        got = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
        assert sum(got) > 35e6 and max(got) < 10e6, name
    spark.conf.set(limit, "1m")
    corpus_pipeline.STAGES[0][1](spark, rows.where("false"), "/root/testdata/sf0.001")
    assert spark.conf.get(limit) == "1m"
    spark.conf.unset(limit)


def test_a_block_of_languages_takes_little_room():
    texts = pa.array(["quelques mots d'une langue " * 100] * 800)  # 2 MB
    languages.normalised(texts.slice(0, 1))  # the table of letters stays
    tracemalloc.start()
    for block in blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), 0, languages.BLOCK):
        for _ in languages.features(*languages.normalised(block.column(0))[:2]):
            pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6


@pytest.mark.parametrize("labelled", [[], [(9999, 1)], [(None, 1), (3, None)], [(0, 1)], [(i, 1) for i in range(10)]])
def test_civil_stage_keeps_what_no_example_is_near(spark, tmp_path, labelled):
    docs = frame(spark, [f"text number {i} of {'many' if i % 2 else 'some'} words" for i in range(20)] + [None, ""])
    spark.createDataFrame(labelled, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.keep_civil(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(22))
