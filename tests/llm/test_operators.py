"""Every operator against a brute-force version on a small table with odd rows."""

import collections
import hashlib
import math
import random
import re
import sys
import zlib

import numpy as np
import pytest
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th long, size long, h long, row long"


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    syllables = "an the ti on re en shi wor lo ka é ß 1".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    base = [" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(50)]
    long = " ".join(word() for _ in range(4000))
    shared = " ".join(word() for _ in range(60))
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100, base[3]), (101, base[3]), (101, base[3]), (102, base[4] + " x"), (103, ""), (104, None), (105, "  \t\n"),
            (106, long), (107, long[5000:9000] + shared), (108, shared + " " + base[7]), (None, base[9]), (None, None), (109, "A b")]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", [None, "a", "b", "c"][k % 4], None, 1, 2, 3, 4) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return collections.Counter(rows)


# op1

def vectors(spark, n=300):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + k, x[0].tolist()) for k in range(40)] + [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [None] * 8),
                                                              (2004, [1.0]), (None, x[1].tolist()), (5, x[5].tolist())]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_nearest_against_brute_force(spark):
    from quarry.llm.ann import nearest
    rows, frame = vectors(spark)
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    got = collections.defaultdict(list)
    for r in nearest(frame, k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in good if i % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        want = sorted((-(good[q] * v).sum(), i) for i, v in good.items() if i != q)[:5]
        assert len(found) == 5 and q not in [i for i, _ in found]
        assert all(abs(s - (good[q] * good[i]).sum()) < 1e-12 for i, s in found)
        hits += len({i for _, i in want} & {i for i, _ in found})
        total += 5
    assert hits / total >= 0.9


def test_nearest_returns_all_of_few(spark):
    from quarry.llm.ann import nearest
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in nearest(frame).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert nearest(frame.limit(0)).count() == 0


def test_pigeonhole_retrieves_every_code_within_the_radius():
    from quarry.llm.ann import bucket_hits, hamming, within_radius
    rng = np.random.default_rng(1)
    index, queries = (rng.integers(0, 1 << 16, (n, 4)).astype(np.uint16) for n in (2000, 10))
    index[:200] = queries[0] ^ (1 << rng.integers(0, 16, (200, 4))).astype(np.uint16)
    for radius in (0, 3, 4, 22, 40):
        assert (within_radius(index, queries, radius) == (hamming(queries, index) <= radius)).all()
    values = np.unique(index[:, 0])
    assert (bucket_hits(values, queries[:, 0], 1) == (np.bitwise_count(values[None] ^ queries[:, 0, None]) <= 1)).all()


# op2

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/">Menu</a></li></ul></nav><div class="ad">Buy</div><article class="post-%d"><h1>Head &amp; more</h1><p>One  <b>two</b>
three<br>four<p>Five &lt;six&gt; %s</p><ul><li>seven<li>eight</ul><form><input>sign up</form><div class="comments"><p>first!</p></div></article>
<aside>side</aside><footer>&copy; foot</footer>"""


def test_main_text_keeps_the_article_only(spark):
    from quarry.llm.html_text import extract_main_text
    words = "long enough article text " * 20
    rows = [(k, f"http://h.example/{k}", PAGE % (k, words)) for k in range(3)] + [(7, None, None), (8, "x", ""), (9, "http://p.example/", "plain &amp; text")]
    got = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Head & more\nOne two three four\nFive <six> " + words.strip() + "\nseven\neight"
    assert got[0] == got[1] == got[2] == (want, len(want))
    assert got[7] == got[8] == ("", 0) and got[9] == ("plain & text", 12)


def test_main_text_drops_named_noise_only():
    from quarry.llm.html_text import main_text
    long = "long enough article text " * 40
    parts = ["First paragraph of some length.", long.strip(), "Last paragraph."]
    inner = f"<p>{parts[0]}</p><section class=body><p>{parts[1]}</p></section><p>{parts[2]}</p>"
    for page in (f"<nav>menu</nav><main>{inner}</main><footer>foot</footer>", f'<div class="has-sidebar"><div class="with-header">{inner}</div>'
                 '<div class="sidebar">side</div></div>', f'<div style="overflow:hidden">{inner}</div><div hidden>no</div>',
                 f'<div class="overflow-hidden" data-x="hidden">{inner}</div><div style="color:red; display: none">no</div>'):
        assert main_text(page) == "\n".join(parts)
        assert main_text(page, ["/main/section.body", "/div/section.body", "/div.overflow-hidden/section.body"]) == "\n".join(parts)


# op3

def simhash(text):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, near):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= near:
                parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(prints)):
        groups[find(k)].append(k)
    return {k: min((ids[m] for m in g if ids[m] is not None), default=None) for g in groups.values() for k in g}


def test_simhash_classes(docs, texts, empty):
    from quarry.llm.simhash import drop_near_duplicates, hex_fingerprint, simhash_classes
    prints = [simhash(t) for _, t in texts]
    want = components(prints, [i for i, _ in texts], 2)
    got = simhash_classes(docs).select("doc_id", hex_fingerprint("fp").alias("f"), "component_id").collect()
    assert bag(tuple(r) for r in got) == bag((i, f"{prints[k]:016x}", want[k]) for k, (i, _) in enumerate(texts))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len({c for c in want.values()})
    assert simhash_classes(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("limit", [1000, 2])
def test_links_of_pairs_and_of_masks_agree(spark, limit):
    from quarry.llm.components import connected_components
    from quarry.llm.simhash import close_pairs
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(8):
            prints.add(x)
            x ^= 1 << rng.randrange(64) ^ 1 << rng.randrange(64) if rng.random() < 0.7 else 7 << rng.randrange(60)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long"), 2, pairs_up_to=limit)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert {k: roots.get(s, s) for k, s in enumerate(signed)} == components(prints, signed, 2)


def test_components_of_a_long_chain(spark):
    from quarry.llm.components import connected_components
    got = connected_components(spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7)], "src long, dst long")).collect()
    assert {r.node: r.root for r in got} == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


# op4

def test_toxicity_on_held_out_rows(spark):
    from quarry.llm.toxicity import drop_toxic, score_toxicity
    rng = random.Random(2)
    plain = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.2
        words = [rng.choice(plain) for _ in range(rng.randint(3, 60))]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Grubbly", "smorf", "zoomble" + rng.choice(plain)])
        rows.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    truth = {i: any(w in t.lower() for w in ("grubbly", "smorf", "zoomble")) for i, t in rows}
    frame = spark.createDataFrame(rows + [(None, "smorf"), (5000, ""), (5001, None)], "doc_id long, text string")
    given = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = score_toxicity(frame, given).collect()
    assert len(got) == 1503 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert {r.doc_id: r.predicted for r in got}[5000] == 0
    kept = drop_toxic(frame, given)
    assert kept.columns == frame.columns and kept.where("doc_id = 5000").count() == 1
    assert score_toxicity(frame.limit(0), given).count() == 0
    assert score_toxicity(frame, given.limit(0)).where("predicted = 1").count() == 0


def test_toxicity_counts_all_labelled_texts(spark, monkeypatch):
    from quarry.llm import toxicity
    rows = [(i, f"common words {'smorf' if i % 9 == 0 else 'fine'} w{chr(97 + i % 26)}") for i in range(800)]
    frame = spark.createDataFrame(rows + [(5, "common twice")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(0, 3000)], "doc_id long, toxic int")
    seen = []
    mine = toxicity.mine_features
    monkeypatch.setattr(toxicity, "mine_features", lambda *a: seen.append((a[-2:], mine(*a))) or seen[-1][1])
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 50)
    toxicity.fit(frame, labels)
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    n_pos = sum(i % 9 == 0 for i, _ in train)
    (got, mined), = seen
    assert got == (n_pos, len(train) - n_pos + (zlib.crc32(b"5") % 4 != 2))
    assert dict(zip(mined["feature"], zip(mined["pos"], mined["neg"], strict=True), strict=True))["smorf"] == (n_pos, 0)


def test_toxicity_finds_features_of_many_texts_at_once(monkeypatch):
    from quarry.llm import toxicity
    texts = ["\u0391\u03a3'\u0391 \u039f\u0394\u039f\u03a3 \u03a3", "\u0130stanbul \u212aelvin \u1e9e", "a1b2 c_d \u00b2\u00bd \u2167 x\u0663y \u4e94\u767e", None, "",
             "\u00e9t\u00e9 na\u00efve-\u00c9COLE \U0001f600ab\U0001d49ccde", "\x85abcd\xa0efgh\u200bab", "smorf Smorfed smor smorf"]
    every = sorted(set().union(*map(toxicity.text_features, texts)))
    table = {f: k for k, f in enumerate(f for k, f in enumerate(every) if k % 3)}
    for piece in (1 << 18, 10):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        got = toxicity.feature_finder(table)(texts)
        assert [own.tolist() for own in got] == [sorted(table[f] for f in toxicity.text_features(t) if f in table) for t in texts]
    assert [own.tolist() for own in toxicity.feature_finder({})(["a", None])] == [[], []] and toxicity.feature_finder(table)([]) == []


def test_toxicity_scores_rare_words_without_a_step_a_word():
    from quarry.llm.toxicity import ToxicityModel
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + "ling" for a in letters for b in letters for c in letters]
    model = ToxicityModel(["smorf", "smor*"], np.array([2.0, 1.0]), -3.0, [], np.zeros((0, 2)), np.zeros(0, int), 0.1)
    model.score(["warm"])
    steps = 0

    def count(frame, event, arg):
        nonlocal steps
        steps += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        got = model.score([" ".join(words), " ".join(words[:100]) + " smorf", None])
    finally:
        sys.setprofile(None)
    assert got.tolist() == pytest.approx([1 / (1 + np.exp(3)), 0.5, 1 / (1 + np.exp(3))])
    assert steps < len(words) / 10  # a call a word and more, when every word was worked out in Python


# op5

def test_url_rules(spark):
    from quarry.llm.url_rules import judge_urls, rules_frame
    urls = [None, "nothing", "http://A.Example.NET/en/x?q", "http://example.net/de", "http://example.net", "http://xexample.com/de/a", "http://m.example.com/de/",
            "http://m.example.com/de", "https://q.org/fr/a/b#c", "http://net/", "http://a.net:80/", "x://y://net/z", "http:///path", "http://b.net/" + "s/" * 500]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("net", "/s/s/par", "allow")]

    def judge(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (lowered(m[1]), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fit, default=(0, None, "allow"))
        return host, path, rule, verdict
    frame = spark.createDataFrame(list(enumerate(urls)) + [(99, urls[2])], "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in judge_urls(frame, rules_frame(spark, rules)).collect()}
    assert got == {**{k: judge(u) for k, u in enumerate(urls)}, 99: judge(urls[2])}
    assert judge_urls(frame, rules_frame(spark, [])).where("verdict = 'allow' and rule is null").count() == len(urls) + 1


# op6

def test_decontamination(spark):
    from quarry.llm.decontaminate import benchmark_matches, drop_contaminated, edit_match, words_of
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(300)] + ["the", "of", "and"] * 40
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [make(n) for n in (14, 25, 40, 60, 3)]
    docs, want = [], set()
    for k, item in enumerate(items):
        edited = list(item)
        for _ in range(len(item) // 10):
            edited[rng.randrange(len(edited))] = "changed"
        broken = [w if rng.random() < 0.4 else "other" for w in item]
        for kind, body in enumerate((item, edited, broken)):
            docs.append((10 * k + kind, " ".join(make(30) + body + make(30))))
    for i, text in docs:
        ids = {w: n for n, w in enumerate(dict.fromkeys(words_of(text)))}
        region = np.array([ids[w] for w in words_of(text)])
        for k, item in enumerate(items):
            distance, _ = edit_match(np.array([ids.get(w, -1) for w in item]), region)
            if distance <= int(0.2 * len(item) + 1e-9):
                want.add((i, k))
    frame = spark.createDataFrame(docs + [(900, None), (901, ""), (None, " ".join(items[1]))], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w).upper()) for k, w in enumerate(items)] + [(50, None), (51, "!!")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in benchmark_matches(frame, bench).collect()}
    assert got == want | {(None, 1)}
    kept = {r.doc_id for r in drop_contaminated(frame, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want} | {900, 901}
    assert benchmark_matches(frame, bench.limit(0)).count() == 0 and benchmark_matches(frame.limit(0), bench).count() == 0


def test_decontamination_misses_no_item_within_the_limit():
    from quarry.llm.decontaminate import Screen
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    items = [fresh(n) for n in (1, 4, 5, 6, 7, 8, 9, 12, 16, 30, 55) for _ in range(40)] + [["the"] * 8, ["a", "b"] * 4]
    texts, want = [], []
    for k, item in enumerate(items):
        edited = list(item)
        for place in rng.sample(range(len(item)), len(item) // 5):
            edited[place] = rng.choice(["", "changed", edited[place] + " added"])
        for body in (item, edited):
            texts.append(" ".join(fresh(rng.randint(0, 30)) + body + fresh(rng.randint(0, 30))))
            want.append(k)
    screen = Screen([(k, " ".join(item)) for k, item in enumerate(items)])
    assert all(k in {m[0] for m in found} for k, found in zip(want, screen.matches(texts), strict=True))


# op7

def test_token_files_round_trip(docs, texts, empty):
    import public_tokenizers
    from quarry.llm.token_files import token_digest
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows, start = [], 0
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        rows.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_digest(docs, path, file_ids=500).collect()]
    known = lambda rows: bag(r for r in rows if r[0] is not None)  # noqa: E731  equal null ids are in no defined order
    assert known(got) == known(rows) and bag((r[0], *r[2:]) for r in got) == bag((r[0], *r[2:]) for r in rows)
    assert token_digest(empty, path).count() == 0


def test_ids_of_pieces_are_those_of_whole_texts():
    import public_tokenizers
    from quarry.llm.token_files import encode_texts
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = ["\u0130. K. x", "\u0958. A, a.. U.S.", "A<|endoftext|>B <|ENDOFTEXT|> X.", "\tA\nB\rC\x0b.\x0cD\x85.\x1c,\xa0e.",
           "\u03a3. \u03b1\u03a3, \u01c5. 1\u00b2.", " \u0301. ,. .,", "x' 'S don'T.", ""]
    rnd = random.Random(3)
    letters = "aZ\u00e9\u00c9\u00df\u00ff\u00f7\u00d7'.,!<|>-3 \t\n\u0301\u0338\u0130\u03a3\u00aa`~{\xa0s"
    odd += ["".join(rnd.choices(letters, k=rnd.randint(1, 9))) for _ in range(3000)]
    for text, got in zip(odd, encode_texts(odd, path, 2), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_token_files_bound_their_batches(spark, docs):
    import public_tokenizers
    from quarry.llm.token_files import token_digest
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(64 << 20))
    try:
        token_digest(docs, public_tokenizers.path("word_bpe_49k.json"))
        assert int(spark.conf.get(name)) <= 4 << 20
    finally:
        spark.conf.set(name, before)


def test_kept_pieces_take_few_bytes_and_dropped_ones_change_nothing(monkeypatch):
    import tracemalloc

    import public_tokenizers
    import pyarrow as pa
    from quarry.llm import token_files
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, rng = Tokenizer.from_file(path), np.random.default_rng(3)
    words = ["".join(w) for w in rng.choice(list("abcdefghijkl"), (80_000, 9))]
    texts = [" ".join(words[k:k + 1000]) for k in range(0, len(words), 1000)]
    monkeypatch.setattr(token_files, "_loaded", {})
    monkeypatch.setattr(token_files, "GROUP_BYTES", 50_000)
    cache = token_files._load(path)[1]
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for _ in token_files.encode_texts(texts, path, 2):
        pass
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 64 * len(words), held
    cache.limit = 3_000  # what is known is dropped again and again
    texts = [f"{t} The, the {words[0]}! l'\u00e9t\u00e9 {t[:5]}" for t in texts[::-8]]
    for text, got in zip(texts, token_files.encode_texts(texts, path, 2), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_ids_of_a_tokenizer_that_keeps_spaces():
    import public_tokenizers
    from quarry.llm.token_files import encode_texts
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, texts = Tokenizer.from_file(path), ["A b  c.", None, "The the\n\u00e9 <|endoftext|> x"]
    for text, got in zip(texts, encode_texts(texts, path, 2), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 5000])
def test_frame_of_reference_round_trip(n):
    from quarry.llm.token_files import decode_blocks, encode_ids
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50_000, n).astype("<u4")
    ids[::97] = 2**32 - 1
    ids[n // 2:n // 2 + 1100] = 7
    index, data = encode_ids(ids)
    assert (decode_blocks(index, memoryview(data))[:n] == ids).all()
    if n == 5000:
        assert (decode_blocks(index, memoryview(data), 2, 3) == ids[2048:3072]).all()


# op8

def ppm(train, texts, order, floor):
    """Symbol by symbol, from the definition."""
    grams = collections.Counter()
    pad = bytes([0xFE]) * order
    streams = [pad + (t or "").encode() + b"\xff" for t in train]
    total = sum(len(s) - order for s in streams)
    for s in streams:
        for at in range(order, len(s)):
            for k in range(order + 1):
                grams[s[at - k:at + 1]] += 1
    children, full = collections.defaultdict(dict), collections.Counter()
    for g, n in grams.items():
        full[g[:-1]] += n
        if n >= floor * total:
            children[g[:-1]][g[-1]] = n
    out = []
    for t in texts:
        s, logs = pad + (t or "").encode() + b"\xff", 0.0
        for at in range(order, len(s)):
            context = next((s[at - k:at] for k in range(order, -1, -1) if children.get(s[at - k:at])), None)
            gone: dict = {}
            while context is not None:
                own = {c: n for c, n in children[context].items() if c not in gone}
                rest = full[context] - sum(children[context][c] for c in gone)
                if s[at] in own:
                    logs += math.log10((own[s[at]] - 0.5) / rest)
                    break
                if rest > 0:
                    logs += math.log10((len(own) / 2 + full[context] - sum(children[context].values())) / rest)
                gone = children[context]
                context = context[1:] if context else None
            else:
                logs -= math.log10(256 - len(gone))
        out.append(logs)
    return out


@pytest.mark.parametrize("floor", [0.0, 2e-3])
def test_lm_scores(docs, texts, empty, floor):
    from quarry.llm.lm_score import lm_scores
    train = [t for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 10]
    counts = collections.Counter(w for t in train for w in WORD.findall(lowered(t)))
    tokens, distinct = sum(counts.values()) + len(train), len(counts) + 1
    scale = math.log10(tokens + 0.1 * (distinct + 1))
    scores = ppm(train, [t for _, t in texts], 3, floor)
    want = collections.defaultdict(list)
    for (i, t), s in zip(texts, scores, strict=True):
        words = WORD.findall(lowered(t))
        base = sum(math.log10(counts[w] + 0.1) - scale for w in words) + math.log10(len(train) + 0.1) - scale
        want[i, len(words) + 1, sum(counts[w] > 0 for w in words) + 1, tokens].append((base, s))
    got = collections.defaultdict(list)
    for r in lm_scores(docs, order=3, floor=floor, word_floor=5e-3).collect():
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 10 == 0)
        got[r.doc_id, r.n_tokens, r.n_known, r.train_tokens].append((r.base_score, r.score))
    assert set(got) == set(want)
    assert all(np.allclose(sorted(got[k]), sorted(want[k]), rtol=1e-9) for k in want)
    assert lm_scores(empty).count() == 0


@pytest.mark.parametrize("gram_floor", [2e-3, 2.0])
def test_lm_scores_know_rare_grams(docs, texts, gram_floor, monkeypatch):
    from quarry.llm import lm_score
    monkeypatch.setattr(lm_score, "BUCKET", 10_000)
    train = [t for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 10]
    want = sorted(ppm(train, [t for _, t in texts], 5, 0.0))
    got = sorted(r.score for r in lm_score.lm_scores(docs, gram_floor=gram_floor).collect())
    assert np.allclose(got, want, rtol=1e-9)


# op9

def test_mixture(docs, texts, empty):
    from quarry.llm.mixing import mix, plan_mix, split_tree
    planned = plan_mix(docs).select("doc.doc_id", "doc.source", "size", "source_size", "target", "draws").collect()
    assert len(planned) == len(texts)
    sizes = collections.Counter()
    for r in planned:
        sizes[r.source] += r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = dict(zip(names, (3, 1, 2, 3), strict=True))
    level, capped = 0.0, set()
    while True:
        level = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)) / sum(weights[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and level * weights[s] > 2 * sizes[s]}
        if not more:
            break
        capped |= more
    taken = collections.Counter()
    for r in planned:
        assert r.source_size == sizes[r.source] and abs(r.target - min(2 * sizes[r.source], level * weights[r.source])) < 1e-6
        assert len(r.draws) <= 2 and len({d.copy for d in r.draws}) == len(r.draws)
        taken[r.source] += r.size * len(r.draws)
    assert all(abs(taken[r.source] - r.target) <= 0.5 * max(x.size for x in planned if x.source == r.source) for r in planned)
    again = plan_mix(docs.repartition(5)).select("doc.doc_id", "size", "draws").collect()
    key = lambda rows: bag((r.doc_id, r.size, tuple(map(tuple, r.draws))) for r in rows)
    assert key(again) == key(planned)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert bag(r.doc_id for r in mixed.collect()) == sum((bag({r.doc_id: len(r.draws)}) for r in planned), bag([]))
    assert plan_mix(empty).count() == 0 and mix(empty).count() == 0
    quotas, totals = np.array([5, 0, 90, 33]), np.array([32, 32, 64])
    dealt = split_tree(quotas, totals, np.random.default_rng(0))
    assert (dealt.sum(axis=0) == quotas).all() and (dealt.sum(axis=1) == totals).all() and (dealt >= 0).all()


# op10

def removed(texts, size):
    seen, out = set(), []
    place = lambda x: (x[0] is None, x[0] or 0)
    for i, t in sorted(texts, key=place):
        raw = (t or "").encode()
        mask = bytearray(len(raw))
        for p in range(len(raw) - size + 1):
            if raw[p:p + size] in seen:
                mask[p:p + size] = b"\1" * size
            seen.add(raw[p:p + size])
        kept = bytes(c for c, m in zip(raw, mask, strict=True) if not m)
        out.append((i, len(raw), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return bag(out)


@pytest.mark.parametrize(("size", "hot"), [(100, 20_000), (64, 20_000), (100, 1), (45, 1)])
def test_repeats(docs, texts, empty, size, hot, monkeypatch):
    from quarry.llm import repeats
    monkeypatch.setattr(repeats, "HOT", hot)
    assert bag(tuple(r) for r in repeats.repeat_digest(docs, size=size).collect()) == removed(texts, size)
    assert repeats.repeat_digest(empty, size=size).count() == 0


def pieces_around(middle, n, size, seed=1):
    """Rows of TEXT_PIECE: ``n`` different pieces with one text in the middle, and the texts."""
    from quarry.llm import repeats
    rng = random.Random(seed)
    around = lambda k: bytes(rng.choices(b"abcdefgh ", k=k))
    texts = sorted(around(size - len(middle)) + middle + around(size - len(middle)) for _ in range(n))
    columns = [[7] * n, list(range(n)), [0] * n, [0] * n, [size - len(middle)] * n, [len(t) for t in texts], texts]
    return repeats._named_batch(columns, repeats.TEXT_PIECE), texts


def test_repeats_merge_only_strings_that_may_occur_again(monkeypatch):
    from quarry.llm import repeats
    merged = []
    whole = repeats.merged_blocks
    monkeypatch.setattr(repeats, "merged_blocks", lambda data, *rest: merged.append(len(data)) or whole(data, *rest))
    batch, texts = pieces_around(b"a line that many documents have, with other words around", 500, 100)
    assert sum(b.num_rows for b in repeats._compare(100, 20_000)(iter([batch]))) == 0 and not merged
    texts[400] = texts[3][5:120] + texts[400][115:]  # strings 5 to 20 of another piece
    order = sorted(range(500), key=lambda k: texts[k])
    batch = repeats._named_batch([[7] * 500, order, [0] * 500, [0] * 500, [0] * 500, [len(texts[k]) for k in order], [texts[k] for k in order]], repeats.TEXT_PIECE)
    found = [tuple(r.values()) for b in repeats._compare(100, 20_000)(iter([batch.slice(0, 250), batch.slice(250)])) for r in b.to_pylist()]
    assert found == [(400, 0, 0, 115, None, None)] and sum(merged) == 115  # the other's are equal bytes and wait for nothing


def test_repeats_hot_minimisers_go_part_by_part():
    from quarry.llm import repeats
    size, text = 100, bytes(random.Random(2).choices(b"abcdefgh ", k=400))
    for a, b, own in ((30, 198, 98), (30, 198, 120), (31, 150, 60), (0, 100, 68), (50, 151, 51)):
        off = own - a
        if off - (b - a - size) < 0:
            continue
        piece, first, end, at, key = repeats._parts(np.array([a]), np.array([b]), np.array([off]), size)
        starts = [w for x, y in zip(first, end, strict=True) for w in range(x, y - size + 1)]
        assert sorted(starts) == list(range(a, b - size + 1)) and (piece == 0).all() and (at == own - first).all()
        assert len(piece) <= (b - a - size + 1) // repeats.PART + 2
        for x, y, k in zip(first, end, key, strict=True):
            assert y - size <= k <= x + size and x <= k and k + size - repeats.PART + 1 <= y
            for w in range(x, y - size + 1):  # each string has the key, at the place its own distance tells
                assert w <= k and k + size - repeats.PART + 1 <= w + size and k == own - (own - w) // repeats.PART * repeats.PART
    batch, texts = pieces_around(b"a line that many documents have, with other words around", 50, size)
    out = [r for b in repeats._compare(size, 10)(iter([batch.slice(0, 8), batch.slice(8)])) for r in b.to_pylist()]
    assert {(r["doc_id"], r["a"], r["piece"]) for r in out} == {(k, p, t[p:p + size]) for k, t in enumerate(texts) for p in range(len(t) - size + 1)}


@pytest.mark.parametrize("hot", [2, 8, 20_000])
def test_repeats_of_a_common_line(spark, hot, monkeypatch):
    from quarry.llm import repeats
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(4)
    around = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    lines = [around(60), around(76), around(140), around(95)]
    ends = [around(40) for _ in range(3)]
    texts = [(k, around(rng.randint(0, 90)) + rng.choice(ends) + rng.choice(lines) + rng.choice(ends)[:rng.randint(0, 40)] + around(rng.randint(0, 90))) for k in range(150)]
    texts += [(None, texts[3][1]), (500, texts[4][1] + "x"), (501, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert bag(tuple(r) for r in repeats.repeat_digest(docs).collect()) == removed(texts, 100)


def test_wide_symbols_are_dealt_stably():
    from quarry.llm.bwt import _stable_order
    rng = np.random.default_rng(0)
    for values in (rng.integers(0, 1 << 32, 5000, dtype=np.uint32) >> np.uint32(14), rng.integers(0, 50, 5000).astype(np.uint16), np.empty(0, np.uint32)):
        assert (_stable_order(values) == np.argsort(values, kind="stable")).all()


def test_merged_blocks_share_their_first_letters():
    from quarry.llm.bwt import merged_blocks
    rng = np.random.default_rng(0)
    strings = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in rng.integers(12, 60, 80)]
    strings += strings[:5]
    lengths = np.array([len(s) for s in strings])
    data = b"".join(strings)
    ends = np.repeat(np.cumsum(lengths), lengths)
    for depth in (10, 12, 7):
        order, block = merged_blocks(np.frombuffer(data, np.uint8), lengths, 200, depth)
        whole = order + depth <= ends[order]
        of = collections.defaultdict(set)
        for p, b in zip(order[whole].tolist(), block[whole].tolist(), strict=True):
            of[b].add(data[p:p + depth])
        assert all(len(v) == 1 for v in of.values()) and len({next(iter(v)) for v in of.values()}) == len(of)
        heads = [data[p:p + depth] for p in order[whole].tolist()]
        assert heads == sorted(heads)


# pipeline

def test_pipeline_stages(spark, tmp_path_factory):
    import corpus_pipeline
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.schema.names == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = corpus_pipeline.written(out, "test-stage")
        counts.append(docs.count())
    assert 0 < counts[3] <= counts[2] <= counts[1] <= counts[0]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == counts[4]
