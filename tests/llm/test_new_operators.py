"""Phrases, conversation trie and page text against brute force or DuckDB on small tables, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib
from html import unescape

import duckdb
import pandas as pd
import pytest

from pyspark.sql import functions as F

from delaycast.llm import ann, jaccard, licenses, pages, phrases, queries, trie

SF = "/root/testdata/sf0.001"


def tuples(frame):
    return sorted((tuple(None if pd.isna(x) else x for x in r) for r in frame.itertuples(index=False)), key=repr)


# ---- 11: phrases

def phrases_brute(rows, least, most):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, min(5, len(w) - i) + 1):
                    f[lang, tuple(w[i: i + m])] += 1
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inner = set()
    for (lang, p), v in often.items():
        for m in range(2, len(p)):
            inner |= {(lang, p[i: i + m]) for i in range(len(p) - m + 1) if often.get((lang, p[i: i + m]), 1e18) <= v}
    out = collections.defaultdict(list)
    for (lang, p), a in often.items():
        if (lang, p) not in inner:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, le, r) in enumerate(sorted(found)[:most]))


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(11)
    words = ["The", "of", "é", "È", " x", "new", "york", "CITY", "a\x1cb", "\U0001f600"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "? "]) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "en", "de", None])))
    rows += [(None, "en"), ("", None), ("  \t", "fr"), (".,;", "fr"), (" ".join(["new york city"] * 400), "en"), ("rare words only", "es")]
    return rows + rows[:3]


@pytest.mark.parametrize("ranges, shard", [(10**6, 10**6), (300, 10**6), (40, 50)])
def test_phrases_equal_brute_force(spark, phrase_rows, ranges, shard):
    docs = spark.createDataFrame([(t, lang, "x", 1, 2) for t, lang in phrase_rows], "text string, lang string, phrase string, f int, n int")
    got = phrases.collocations(docs.repartition(3), least=4, most=25, range_words=ranges, shard_words=shard)
    want = phrases_brute(phrase_rows, 4, 25)
    assert len(want) > 40 and sorted(map(tuple, got.collect())) == want
    assert sum(len(p.split()) > 3 for _, _, p, *_ in want) > 0


def test_phrases_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).collect() == []


def test_phrases_query_equals_duckdb(spark):
    duckdb_docs = duckdb.connect()
    duckdb_docs.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.collocations(spark, SF).toPandas()
    assert len(got) and tuples(got) == tuples(duckdb_docs.execute(queries.ORACLES["op11_phrase_collocations"]).df())


def test_packed_automaton_round_trip():
    rng = random.Random(1)
    shard = phrases.Shard()
    for _ in range(40):
        words = phrases.words_of(" ".join(rng.choice("abcde") for _ in range(rng.randrange(1, 30))))
        shard.add(words, len(words))
    windows, weights, words = shard.take()
    got, sums, names = phrases.unpacked(phrases.packed(windows, weights, words))
    names = [b"", *names]
    assert [[names[i] for i in w if i] for w in got] == [[words[i] for i in w if i] for w in windows]
    assert (sums == weights).all()


# ---- 12: conversation trie

def trie_brute(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()), key=repr)


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(12)
    rows = []
    for c in [0, 1, 2, 3, 7, 50, 99, 100, 101, 150, 205, 206, 299, 1007]:
        for t in range(rng.choice([1, 2, 5, 9])):
            rows.append((c, t, rng.choice(["user", None, "assistant"]), rng.choice(["hi", "hello", "", None, "é\U0001f600"])))
    rows += [(5, t, "user", "again") for t in range(75)] + [(6, t, "user", "again" if t < 70 else "x") for t in range(90)]  # deep and shared
    rows += [(8, None, "user", "first"), (8, 3, "b", "x"), (8, 3, "a", "x"), (8, 3, "a", "x"), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 8])
def test_trie_equals_brute_force(spark, conversations, height, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    monkeypatch.setattr(trie, "IDS", 2)
    turns = spark.createDataFrame([(*r, "k", 1) for r in conversations], "conv_id long, turn long, role string, text string, band string, d int")
    got = [tuple(r) for r in trie.nodes(turns.repartition(3), height).collect()]
    assert sorted(got, key=repr) == trie_brute(conversations)


def test_trie_of_an_empty_table(spark):
    assert trie.nodes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_trie_query_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = queries.conversation_trie(spark, SF).toPandas()
    assert tuples(got) == tuples(con.execute(queries.ORACLES["op12_conversation_trie"]).df())


# ---- 13: pages

def lcs_length(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(13)
    for _ in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(16))] for _ in range(2))
        places = pages.shared(a, b)
        rest = iter(b)
        assert len(places) == lcs_length(a, b) and all(a[i] in rest for i in places) and places == sorted(set(places))


@pytest.mark.parametrize("html, want", [
    ("<title>t</title><nav>n</nav><article><h1>A &amp; B</h1><p>one<br>two <b>th</b>ree<p class='ad'>no<p>f&ouml;ur\n five</article><footer>f</footer>", "A & B one two three för five".replace("för", "föur")),
    ("<main><div class='post'>x<aside>s</aside>y</div><form>f</form><section id='comments'><p>c</p></section></main>", "x y"),
    ("<form><article>in a form</article>rest</form>", "in a form"),
    ("<body class='has-sidebar'><article>a<script>var t='</article>';</script><style>p{}</style><!-- <p>c --><span class='share-bar'>s</span>b</article>", "ab"),
    ("<article>a<article class='comment'>c</article><article>b", "a b"),
    ("<article>1 < 2 &lt; 3 <a title='x>y'>z</a> &#233;&copy</article>", "1 < 2 < 3 z é©"),
    ("<header>h</header><article><header><h1>T</h1></header>x</article>", "T x"),
    ("plain <b>text</b>", "plain text"), ("", ""), (None, ""), ("<nav>only</nav>", ""), ("<article></article>", ""),
])
def test_page_text(spark, html, want):
    rows = spark.createDataFrame([(1, "http://h/a", html, "x")], "page_id long, url string, html string, text string")
    got = pages.main_text(rows).collect()
    assert [tuple(r) for r in got] == [(1, "http://h/a", want, len(want))]


def frame(body, host="h"):
    return f"<body><div>Menu of {host}</div><div>Home</div>{body}<div>Imprint of {host}</div><div>Home</div></body>"


def test_pages_without_an_article_lose_what_their_neighbours_share(spark):
    rows = [(1, "http://h/news/1", frame("<p>first story of the day</p><p>Home</p><p>more of it here</p>")), (2, "http://h/news/2", frame("<p>second story, quite different</p>")),
            (3, "http://h/news/2?page=2", frame("<p>second story, quite different</p>")),  # a copy tells nothing
            (4, "http://other/news/1", frame("<p>alone</p>", "other")), (5, None, frame("<p>no url</p>")), (None, "http://h/zoo", frame("<p>zoo story is another one</p>")),
            (7, "http://copy/a", frame("<p>" + "long text " * 30 + "</p>", "copy")), (8, "http://copy/b", frame("<p>" + "long text " * 30 + "</p><p>new</p>", "copy"))]
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[1] == "first story of the day Home more of it here"
    assert got[2] == got[3] == "second story, quite different"
    assert got[None] == "zoo story is another one"
    assert got[4] == "Menu of other Home alone Imprint of other Home"
    assert got[7].startswith("Menu of copy Home long") and got[8].endswith("new Imprint of copy Home")


def test_pages_of_an_empty_table(spark):
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_query_equals_brute_force(spark):
    got = {r["page_id"]: r for r in queries.html_extraction(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        parts = re.split(r"</?(?:p|h1|br)[^>]*>", re.search(r"<article>(.*?)</article>", r["html"], re.S)[1])
        want = " ".join(x for x in (" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts) if x)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


# ---- rows and columns that earlier versions lost or replaced

def test_one_of_each_keeps_different_texts_of_one_id(spark):
    a, b = "one two three four five six", "quite another text of some more words"
    rows = [(1, a), (1, b), (2, a), (1, a), (3, ""), (3, None), (4, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, text_key string")
    got = sorted(((r["doc_id"], r["text"] or "") for r in jaccard.one_of_each(docs).collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (3, ""), (4, ""), (None, a)], key=repr)


def test_vectors_of_one_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [0.0, 1.0]), (0, [1.0, 0.2])]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 3)) for r in got) == sorted(
        [(0, 1, 1, 0.995), (0, 2, 0, 0.981), (0, 3, 1, 0.0), (0, 1, 1, 0.995), (0, 2, 0, 0.981), (0, 3, 1, 0.196)])


def test_columns_named_like_the_operators_own_stay(spark):
    import corpus_pipeline as p

    names = ["_n", "_h", "_t", "_sum", "_cell", "_before", "mix_slot", "quality_score", "_", "_units", "_row", "_dir", "text_key"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    for stage in (p.good_quality, p.near_copies, p.repeats, p.mixture):
        rows = stage(spark, docs, SF).collect()
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in names), stage
        assert stage(spark, docs, SF).columns == docs.columns
    files = docs.select(F.col("doc_id"), F.concat(F.lit("/a/"), "doc_id").alias("path"), "text", *names)
    assert all(r[c] == f"{c}{r['doc_id']}" for r in licenses.inherited(licenses.scanned(files)).collect() for c in names)


def test_new_queries_are_registered():
    import __spark_entry__ as e

    assert {"op11_phrase_collocations", "op12_conversation_trie", "op13_html_extraction"} <= set(e.queries())
    assert {"op11_phrase_collocations", "op12_conversation_trie"} <= set(e.oracle_sql())


def test_pages_of_a_table_of_one_page_and_long_lines(spark):
    long = "word " * 200_000
    got = pages.main_text(spark.createDataFrame([(1, "http://h/a", f"<div>{long}</div><div>end</div>")], "page_id long, url string, html string")).first()
    assert got["text"] == f"{long.strip()} end"


def test_pages_with_an_article_are_differenced_too(spark):
    def page(menu, article):
        return f"<nav><ul><li>{menu}</li><li>Home</li></ul></nav><article><p>a passage of both</p><p>{article}</p></article><div class='footer'>Imprint</div><div>Legal</div>"

    rows = [(1, "http://h/news/1", page("m1", "first story of them all")), (2, "http://h/news/2", page("m2", "another one, quite different")),
            (3, "http://other/x", page("m1", "alone")), (4, "http://h/news/2?p=2", page("m2", "another one, quite different"))]
    got = {r["page_id"]: r for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # Home, the passage, Imprint and Legal are shared; the check by the markup keeps the passage and takes the menu line away
    assert [(got[i]["n_lines"], got[i]["n_template"]) for i in (1, 2, 3, 4)] == [(6, 4), (6, 4), (6, 0), (6, 4)]
    assert got[1]["text"] == "a passage of both first story of them all" and got[3]["text"] == "a passage of both alone"
    assert got[2]["text"] == got[4]["text"] == "a passage of both another one, quite different"
    assert [t for t, z in pages.lines(rows[0][2])] == ["m1", "Home", "a passage of both", "first story of them all", "Imprint", "Legal"]
