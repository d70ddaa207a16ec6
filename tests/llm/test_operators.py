"""Small fixtures with nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from firelog.llm import (extract_html, fingerprint, jaccard, langid, mixing, pii, sentencepiece, tokens, topk, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n string, cid string"
BASE = " ".join(f"word{i}" for i in range(60))


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "x", "y", "z")
                                  for i, t in enumerate(texts)], SCHEMA).unionByName(
        spark.createDataFrame([(None, "no id here at all, only text", None, None, None, None, None, None)], SCHEMA))


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(random.Random(1).choice(["alpha", "beta", "gamma,", "delta."]) for _ in range(30_000))
    return rows_of(spark, [None, "", " \n\t", "one", "a@b.co call +1 (017) 555-7713", BASE, BASE, BASE + " tail", long,
                           "é中😀 ﬁ", "A B C D E", "a b c d e", "1 2 3"]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_token_counts_are_those_of_the_json_tokenizer(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    path = tokens.vocabulary_path("byte_bpe_50k.tiktoken")
    size = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    rng = random.Random(4)
    pool = [*"ab 1'\n\t.,s ", "<|endoftext|>", "é", "中", " ", " ", "'ll", "  \n", "😀", "́", "the "]
    for _ in range(500):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
        assert tokens.count_one(t, path) == size(t)
    every = [chr(i) for i in range(128, 0x110000) if not 0xD800 <= i < 0xE000]
    for a in range(0, len(every), 4096):
        t = "".join(f"a{c}a {c}1{c}, {c}\n" for c in every[a:a + 4096])
        assert tokens.count_one(t, path) == size(t)
    long = " ".join(rng.choice(["abc", "it's", "a1", "<|endoftext|>"]) for _ in range(60_000))
    assert len(tokens.safe_parts(long)) > 1 and tokens.count_one(long, path) == size(long)
    got = by_id(tokens.token_counts(docs))
    assert (got[0]["n_tokens"], got[0]["n_bytes"], got[8]["over_limit"]) == (0, 0, True) and len(got) == 14
    assert tokens.token_counts(empty).count() == 0


def test_sentencepiece_is_the_library_s(docs, empty):
    import sentencepiece as lib

    enc = sentencepiece.encoder("piece_bpe_32k.model")
    sp = lib.SentencePieceProcessor(model_file=tokens.vocabulary_path("piece_bpe_32k.model"))
    rng = random.Random(3)
    pool = [*"aaabcdethe ofin ...,,'-12\n\t", "    ", "é", "中", "😀", "the ", "ing", "\x00", "ß"]
    for _ in range(1500):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 50)))
        assert enc.encode(t).tolist() == sp.encode(t) and enc.decode(enc.encode(t).tolist()) == t
    t = "".join(rng.choice("abcdeinothrs") for _ in range(20_000))
    assert enc.encode(t).tolist() == sp.encode(t)
    got = sentencepiece.encode(docs)
    assert all(r["decoded_equal"] for r in got.collect())
    back = by_id(sentencepiece.decode(got))
    assert back[9]["text"] == "é中😀 ﬁ" and back[0]["text"] == ""
    assert sentencepiece.encode(empty).count() == 0


def test_language(spark, docs, empty):
    rng = random.Random(5)
    say = lambda ws: " ".join(rng.choice(ws) for _ in range(30))
    words = {"xx": ["thonor", "ander", "ingea"], "yy": ["ñaque", "ción", "losar"]}
    data = spark.createDataFrame([(i, say(words[k]), k) for i, k in enumerate(["xx", "yy"] * 20)], "doc_id long, text string, lang string")
    protos = langid.train(data)
    again = langid.train(data.repartition(7))
    assert all(np.array_equal(protos[k], again[k]) for k in protos)
    assert langid.predict([say(words["xx"]), say(words["yy"]), "12 !", None], protos)[0] == ["xx", "yy", "und", "und"]
    # brute force: the bundle as a sum over the letters' trigrams
    v = {c: langid._letters(np.array([0 if c == " " else ord(c)]))[0].astype(int) for c in "abc "}
    s = " abca "
    want = sum(np.roll(v[s[i]], 2) * np.roll(v[s[i + 1]], 1) * v[s[i + 2]] for i in range(len(s) - 2))
    assert np.array_equal(langid.bundles(["abca"])[0], want)
    assert langid.identify(empty, protos).count() == 0 and len(langid.identify(docs, {}).collect()) == 14
    assert langid.keep_known(docs, protos, 0.0).columns == docs.columns
    assert langid.train(empty) == {}


def test_short_texts_in_a_language_stay(spark):
    rng = random.Random(7)
    say = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    data = spark.createDataFrame([(i, say("aeioulnrst", 200), "xx") for i in range(20)], "doc_id long, text string, lang string")
    protos = langid.train(data)
    short = ["A.", "Avec.", "Lllldoado.", "Ж", "A. " * 5000, say("aeioulnrst", 3)]
    far = [say("бвгджзкмпф", 400), "12 !", "", None]
    scores = langid.predict(short[:4], protos)[1]
    assert scores.min() < 0.1 and langid.predict(far[:1], protos)[1][0] < 0.1
    assert langid.evidence(["A. " * 5000, "", "abc"]).round(6).tolist() == [1.0, 0.0, 3.0]
    rows = spark.createDataFrame(list(enumerate(short + far)), "doc_id long, text string")
    assert sorted(r.doc_id for r in langid.keep_known(rows, protos, 0.1).collect()) == list(range(len(short)))


def test_toxicity_learns_words_and_prefixes(spark, docs, empty):
    rng = random.Random(6)
    clean = [f"w{i}" + "abcdefgh"[i % 8] * 2 for i in range(60)]
    text = lambda bad: " ".join(rng.choice(clean) for _ in range(40)) + (f" zorgl{rng.choice('abcdef')}{rng.choice('klm')}o" if bad else "")
    y = np.array([i % 2 for i in range(300)])
    model = toxicity.train_model([text(k) for k in y], y)
    got = toxicity.score_texts(model, [text(k) for k in y[:100]])
    assert ((got >= toxicity.THRESHOLD) == (y[:100] == 1)).mean() >= 0.97
    assert toxicity.score_texts(model, ["", None])[0] == toxicity.score_texts(model, ["", None])[1] < 0.7
    assert toxicity.score(empty, model).count() == 0 and toxicity.score(docs, model).count() == 14
    assert (toxicity.score_texts(toxicity.train_model(["a"], np.array([0])), ["a"]) < 0.01).all()


def test_pii_base_spans_and_masking(docs, empty):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def brute(t):
        out = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split("."))
                        or k == 2 and 14 <= len(d) <= 19 and pii.luhn(d) or k == 3 and 10 <= len(d) <= 15):
                    out.append((m.start(), m.end(), k))
        return sorted(out, key=lambda s: (s[0], s[2]))

    rng = random.Random(2)
    for _ in range(5000):
        t = "".join(rng.choice("a1@.@.2 +-é(00055") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute(t)
    cards = [c for c in (f"{rng.randrange(10**15, 10**16)}" for _ in range(2000)) if pii.luhn(c)]
    texts = [f"some words {rng.choice([f'ab.{i}@mail{i % 9}.example.com', f'10.{i % 200}.3.4', cards[i % len(cards)], f'+1 (0{i % 90 + 10}) 555-{1000 + i}'])} and more" for i in range(300)]
    model = pii.train_on(texts)
    x, owner, start = pii.windows(texts)
    # the model alone, over all windows of a text, finds the labelled spans again
    alone = pii.reconcile(texts, [[] for _ in texts], pii.decode(model, x), owner, start)
    assert np.mean([set(pii.base_spans(t)) <= set(s) for t, s in zip(texts, alone)]) > 0.9
    got = by_id(pii.detect(docs, model))
    assert got[4]["spans"].startswith("email:0:6,phone:12:29") and got[0]["spans"] == ""
    masked = by_id(pii.mask(docs, model))
    assert masked[4]["text"] == "[EMAIL] call [PHONE]" and masked[4]["n_chars"] == 20 and masked[0]["text"] is None
    assert pii.detect(empty, None).count() == 0 and pii.train(empty) is None


def test_pii_windows_hold_whole_words():
    name = "q" * 60 + "é"
    for text, a, b in [(f"write to {name}@mail.example.com now", 9, 9 + 61 + 17), (f"{name}@mail.example.com", 0, 78), (f"x {'ab' * 30}7{'cd' * 60}", 2, 183)]:
        x, owner, start = pii.windows(["plain", text])
        assert set(owner) == {1} and start.min() <= a and start.max() + pii.WINDOW >= b
    tail = [s.tolist() for s in pii.windows(["a" * 30 + " b 1 c " + "d" * 30])[1:]]
    assert tail == [[0], [9]]  # other words are not needed


def test_mixing_meets_targets(spark, docs, empty):
    rng = random.Random(8)
    data = spark.createDataFrame([(i, "w " * rng.randint(0, 40), f"s{min(i % 9, 5)}" if i % 10 else None) for i in range(2000)],
                                 "doc_id long, text string, source string")
    got = mixing.mix(data).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(data.repartition(5)).collect()))
    taken, target, most = collections.Counter(), {}, collections.Counter()
    for r in got:
        taken[r["source_size"], r["target"]] += r["taken"]
        target[r["source_size"], r["target"]] = r["target"]
        assert r["taken"] <= 2 * r["size"] and len(r["shards"]) == r["copies"]
    assert all(abs(taken[k] - target[k]) <= 40 for k in target)
    goal = mixing.targets([("a", 10), ("b", 1000), (None, 100)])
    assert goal["a"] == 20 and float(sum(goal.values())) == 1665
    tree = mixing.split_tree(np.array([100, 7, 33]), 8, np.random.default_rng(1))
    assert tree.sum(axis=0).tolist() == [100, 7, 33] and tree.min() >= 0
    assert mixing.mix(empty).count() == 0 and mixing.mix(docs).count() == 14
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_min_cut_and_main_text(spark):
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 7)
        s = [rng.randint(-9, 9) for _ in range(n)]
        links = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        cost = lambda side: (sum(-x if k else 0 for x, k in zip(s, side) if x < 0) + sum(0 if k else x for x, k in zip(s, side) if x > 0)
                             + sum(c for i, j, c in links if side[i] != side[j]))
        assert cost(extract_html.min_cut(s, links)) == min(cost(z) for z in itertools.product([False, True], repeat=n))
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy now.</div><article>"
            "<h1>A  title</h1><p>First &amp; long\nparagraph of the text.<br>More.</p><script>var t='</p>'</script><p>Short.</p></article>"
            "<div class=comments><p>I do not agree with any of this at all.</p></div><form><p>Your name, please.</p></form><footer>&copy; me</footer>")
    assert extract_html.main_text(page) == "A title\n\nFirst & long paragraph of the text. More.\n\nShort."
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", "", 2), (None, None, page[:200], 3)], "page_id long, url string, html string, text int")
    assert sorted(r["n_chars"] for r in extract_html.extract(pages).collect())[:2] == [0, 0]
    assert extract_html.extract(pages.limit(0)).count() == 0


def test_names_around_the_whole_page_do_not_empty_it():
    say = lambda n: " ".join(f"word{i}" for i in range(n)) + "."
    for n in (20, 45, 60, 100):
        side = "<div class=sidebar><p>Most read this week, by our readers and friends.</p></div><footer><p>All rights are kept.</p></footer>"
        talk = "<div id=comments><p>I do not agree with any of this at all.</p></div>"
        inner = f"<p>{say(n)}</p><p>{say(n + 5)}</p>"
        want = f"{say(n)}\n\n{say(n + 5)}"
        for head, tail in [("<body class='has-sidebar'>", ""), ("<html class=no-sidebar><body class=nav-open>", ""), ("<body><form id=aspnetForm>", "</form>"),
                           ("<body><div class='page has-sidebar'><form><div class=menu-open>", "</div></form></div>")]:
            for tag in ("<article>", "<article class='post comments-open'>", "<main class=no-sidebar><article class=has-sidebar>"):
                assert extract_html.main_text(f"{head}<nav><a href=/>Home</a></nav>{tag}{inner}</article>{side}{talk}{tail}") == want
        page = f"<body><div class=has-sidebar><nav><a href=/>Home</a></nav><div id=content>{inner}</div></div><footer><p>All rights are kept.</p></footer>"
        assert extract_html.main_text(page) == want
        # names still tell boilerplate that holds articles, or more text than the content
        cards = "".join(f"<article class=comment><p>I think that {say(12)}</p></article>" for _ in range(4))
        assert extract_html.main_text(f"<body><article>{inner}</article><section class=comments>{cards}</section>") == want
        card = "<div class=related><article><p>Read this too, it is new.</p></article></div>"
        assert extract_html.main_text(f"<body class=has-sidebar><div id=content>{inner}{inner}</div>{card}") == f"{want}\n\n{want}"
    both = f"<body><article class='post comments-open'><p>{say(20)}</p></article><article class='post comments-open'><p>{say(30)}</p></article>"
    assert extract_html.main_text(both) == f"{say(20)}\n\n{say(30)}"


def test_elements_without_an_end_tag_keep_the_rest_of_the_page():
    say = lambda n: " ".join(f"word{i}" for i in range(n)) + "."
    opened = ["<button>Menu", "<select><option>One label<option>Two labels", "<object data=x><param name=a>", "<svg viewBox=x><path d=y><text>Icon</text>",
              "<svg><title>Icon", "<math><mi>x</mi>", "<template>", "<noscript>", "<button>A<button>B", "<svg><style/><title>T</title>"]
    want = f"{say(20)}\n\n{say(30)}"
    for tag in opened:
        end = "</title>" if tag.endswith("Icon") else ""  # raw text of its own kind
        for head, first in [(f"<body>{tag}{end}<article>", ""), (f"<body><div class=bar>{tag}{end}</div><article>", ""), ("<body><article>", tag + end),
                            (f"<body><p class=bar><a href=/>{tag}{end}</a></p><article>", ""), ("<body><article>", f"<span>{tag}{end}</span>")]:
            assert extract_html.main_text(f"{head}{first}<p>{say(20)}</p><p>{say(30)}</p></article><footer>&copy; me</footer>") == want, (head, first)
    # with their end tag all of their text goes, whatever they hold
    whole = ["<button><div>Label that is long enough, really.</div></button>", "<object>One.<object>Two, three.</object>Four, five, six.</object>",
             "<template><p>Text of one.<template>Two.</template></p><p>Three of them, all told.</p></template>", "<svg><title>Icon</svg>", "<svg><svg></svg><text>A b c d.</text></svg>",
             "<noscript><iframe src=x><p>Please switch it on, now.</p></noscript>", "<select><option>One<option>Two, three.</select>", "<script>if (a < b) '</p><button>'</script>"]
    for tag in whole:
        assert extract_html.main_text(f"<article><p>{say(20)}</p>{tag}<p>{say(30)}</p></article>") == want, tag
        assert extract_html.main_text(f"<article><p>{say(20)[:-8]} {tag} {say(20)[-7:]}</p><p>{say(30)}</p></article>") == want, tag
    assert extract_html.main_text(f"<article><p>{say(20)}</p><p>{say(30)}</p><script>var x = 1; <p>{say(40)}</p></article>") == want


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, (700, 6)) / 256 * 40
    v[100:300] = v[100]
    rows = [(i, x.tolist(), "c") for i, x in enumerate(v)] + [(900, None, "c"), (901, [float("nan")] * 6, "c"), (902, [1.0], "c"), (None, [0.0] * 6, "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = collections.defaultdict(list)
    for r in topk.top_k(table, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    q = np.floor(256 * v.astype(np.float32).astype(float)).astype(int)
    for i in range(0, 700, 50):
        s = q @ q[i]
        best = sorted((-s[j], j) for j in range(700) if j != i)[:5]
        assert sorted(got[i]) == [(k + 1, j, -x) for k, (x, j) in enumerate(best)]
    assert len(got) == 14 and topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    tree = topk.Tree(np.arange(700), q)
    assert len(tree.bounds) > 1


def test_top_k_ranks_repeated_rows_as_the_sql_does(spark, tmp_path):
    import duckdb

    from firelog.llm.queries import ORACLE_SQL

    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(101)] + [(33, [9.0, 9.0])] * 3 + [(48, [9.0, 8.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("is_query", F.lit("x"))
    table.coalesce(1).write.parquet(str(tmp_path / "embeddings"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op7_top_k"]).fetchall())
    got = sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    assert got == want and sum(r[2] == 33 for r in got) > 3


def test_fingerprints(spark, docs, empty):
    got = fingerprint.fingerprints(docs).collect()
    assert len(got) == 14
    d = {r["doc_id"]: r for r in got}
    assert d[5]["fingerprint"] == d[6]["fingerprint"] and d[5]["near_next"] == 1.0 and d[6]["near_next"] > 0.7
    assert set(d[0]["fingerprint"]) == {"0"} and all(0 <= r["near_edited"] <= 1 for r in got)
    assert fingerprint.fingerprints(empty).count() == 0
    plan = fingerprint.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_jaccard_components_against_brute_force(spark, docs, empty):
    rng = random.Random(9)
    texts = []
    for _ in range(40):
        w = [f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 9, 12, 30, 80]))]
        texts.append(" ".join(w))
        for _ in range(rng.randrange(4)):
            u = list(w)
            u[rng.randrange(len(u))] = "edit"
            texts.append(" ".join(u + ["more"] * rng.randrange(2)))
    passage = " ".join(f"p{i}" for i in range(55))
    texts += [passage + f" own{i} end{i}" for i in range(60)] + [" ".join(f"q{i}x{j}" for j in range(60)) + " " + passage for i in range(30)]
    data = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shingles(t):
        w = t.lower().split()
        return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = by_id(jaccard.join(data))
    assert [got[i]["component_id"] for i in range(len(texts))] == [find(i) for i in range(len(texts))]
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    few = by_id(jaccard.join(docs))
    assert (few[0]["component_id"], few[5]["component_id"], few[7]["component_id"], few[11]["component_id"]) == (0, 5, 5, 10)
    kept = sorted(r["doc_id"] for r in jaccard.one_of_each(docs.unionByName(docs)).where("doc_id > 2").collect())
    assert kept == [3, 4, 5, 8, 9, 10, 12]
    assert jaccard.join(empty).count() == 0


def test_jaccard_of_many_edits_with_split_lists(spark, monkeypatch):
    """Many different edits of one text: salted lists, several leader rounds and places, against brute force."""
    for name, value in (("SALT_ROWS", 20), ("FREQUENT", 2), ("SMALL_LIST", 4), ("LEADERS", 2)):
        monkeypatch.setattr(jaccard, name, value)
    rng, base, texts = random.Random(21), [f"b{i}" for i in range(120)], []
    for i in range(150):
        w = list(base[:rng.choice([100, 110, 120])])
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(60)}"
        texts.append(" ".join(w))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    assert 1 < len(set(label)) < len(sets)
    got = by_id(jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)))
    assert [got[i]["component_id"] for i in range(len(texts))] == label


def test_jaccard_pairs_versions_of_a_text_once(spark, monkeypatch):
    """Versions of one text, most too different to link, share many lists; each pair is made in about one of them."""
    rng, base, texts = random.Random(3), [f"b{i}" for i in range(300)], []
    for i in range(40):
        w = list(base)
        for p in rng.sample(range(300), 8 if i % 10 else 2):
            w[p] = f"e{i}x{p}"
        texts.append(" ".join(w))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    data, made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), []
    plain = type(data).distinct

    def counted(self):
        if self.columns == ["a", "b"]:
            made.append((self.count(), plain(self).count()))
        return plain(self)

    monkeypatch.setattr(jaccard, "FREQUENT", 1000)  # as if the versions were spread over many slices
    monkeypatch.setattr(type(data), "distinct", counted)
    got = by_id(jaccard.join(data))
    assert [got[i]["component_id"] for i in range(len(texts))] == label and 1 < len(set(label)) < len(texts)
    rows, pairs = map(sum, zip(*made[1:], strict=True))  # after the leaders' pairs
    assert 300 < pairs and rows <= 1.5 * pairs


def test_shingles_of_the_smallest_slices(spark):
    for text in ["", "a", "a b", "a b c", "a b c d", "a b c d e", "a b c d e f"]:
        n = len(text.split())
        assert [len(s) for s in jaccard.shingle_sets([text])] == [max(n - 4, min(n, 1))]
        got = jaccard.join(spark.createDataFrame([(4, text), (2, text.upper())], "doc_id long, text string")).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == ({4: 2, 2: 2} if n else {4: 4, 2: 2})
    assert [len(s) for s in jaccard.shingle_sets([])] == []


def test_columns_named_like_the_operators_own(spark):
    names = ["__mix", "__plan", "__copies", "__shards", "__pass", "__shard", "keep_id", "keep_h", "several", "row", "size", "key", "a.b"]
    docs = spark.createDataFrame([(i, f"{BASE} {i // 2}", "en", f"s{i % 3}", *range(len(names))) for i in range(30)],
                                 ["doc_id", "text", "lang", "source", *names])
    mixed = mixing.mixed_rows(docs)
    assert mixed.schema.names == docs.schema.names
    assert {tuple(r)[4:] for r in mixed.collect()} == {tuple(range(len(names)))}
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == want
    kept = jaccard.one_of_each(docs.unionByName(docs)).collect()
    assert [tuple(r) for r in kept] == [tuple(r) for r in docs.where("doc_id = 0").collect()]


def test_one_of_each_with_null_and_repeated_ids(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(50))
    rows = [(None, text("a"), "p"), (None, text("b"), "p"), (None, text("b").upper(), "p"), (None, text("c") + " tail", "p"), (7, text("c"), "p"),
            (None, None, "p"), (None, None, "p"), (None, " ", "p"), (8, "", "p"), (8, text("d"), "p"), (8, text("e"), "p"),
            (9, text("f"), "p"), (9, text("g") + " tail", "p"), (3, text("g"), "p"), (4, text("h"), "q"), (4, text("h"), "p"), (4, text("h"), None)]
    data = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = [(None, "a"), (None, "b"), (7, "c"), (None, None), (None, None), (None, " "), (8, ""), (8, "d"), (8, "e"), (9, "f"), (3, "g"), (4, "h")]
    short = lambda t: t[0].lower() if t and len(t) > 1 else t
    kept = [sorted(map(str, jaccard.one_of_each(d).collect())) for d in (data, data.repartition(5))]
    got = [(r.doc_id, short(r.text)) for r in jaccard.one_of_each(data).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and kept[0] == kept[1]


def test_held_out_accuracy_on_the_tables(spark):
    """Language over the fixture table's held-out fifth, as the query measures it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    got = by_id(langid.identify(docs, langid.train(docs.where(part != 0))))
    pairs = [(r["lang"], got[r["doc_id"]]["lang_pred"]) for r in docs.select("doc_id", "lang").collect() if held(r["doc_id"])]
    assert np.mean([a == b for a, b in pairs]) >= 0.95
