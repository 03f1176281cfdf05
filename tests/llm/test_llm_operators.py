"""Operators of the llm subpackage against brute force, and their defined edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerwatch.llm import (components, decontamination, exact_dedup, html_text, pieces, pii, quality, queries, simhash,
                             token_counts, url_filter, warc)
from ledgerwatch.llm.common import read_table

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def frame(spark, rows, ddl=DOCS):
    return spark.createDataFrame(rows, ddl)


# --- oracles ----------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in cur.description]
    want = sorted((tuple(r) for r in cur.fetchall()), key=str)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == want


# --- op 1 -------------------------------------------------------------------------------------------------------------

def test_patricia_trie_against_a_dict():
    rng = np.random.default_rng(1)
    trie, want = exact_dedup.PatriciaTrie(), {}
    for k in range(4000):
        key, rank = bytes(rng.integers(97, 99, rng.integers(0, 9)).tolist()), (int(rng.integers(0, 50)), k)
        new = trie.insert(key, rank)
        old = want.get(key)
        assert new == (old is None or rank < old[0])
        want[key] = (min(rank, old[0]), old[1] + 1) if old else (rank, 1)
    assert {k: (r, n) for k, r, n in trie.items()} == want


def test_owner_trie_spills_whole_subtrees():
    trie = exact_dedup.OwnerTrie(1000)
    for k in range(20):
        trie.insert((100, k), bytes([k]) * 100, (0, False, k))
    gone = list(trie.spill())
    assert trie.held <= 500 and gone and len(gone) + len(trie.subtrees) == 20


@pytest.mark.parametrize("max_bytes", [1, 500, 1 << 25])
def test_exact_dedup_edges(spark, max_bytes):
    rows = [(5, "a b"), (3, "ab"), (7, " a  b "), (1, None), (2, ""), (4, "\n\t"), (None, "x"), (9, "x"), (9, "x"), (8, "é é"), (6, "y" * 200_000)]
    df = frame(spark, rows).withColumn("len", F.lit(1)).withColumn("hash", F.lit("k")).withColumn("__exact_dedup_len", F.lit(2)).repartition(3)
    got = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.owners(df, max_bytes=max_bytes).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {k: (r["keep_id"], r["group_size"], r["kept"]) for k, r in got.items()} == {
        (5, sha("ab")): (7, 3, False), (3, sha("ab")): (7, 3, False), (7, sha("ab")): (7, 3, True),
        (1, sha("")): (4, 3, False), (2, sha("")): (4, 3, False), (4, sha("")): (4, 3, True),
        (None, sha("x")): (9, 3, False), (9, sha("x")): (9, 3, True), (8, sha("éé")): (8, 1, True), (6, sha("y" * 200_000)): (6, 1, True)}
    kept = exact_dedup.survivors(df, max_bytes=max_bytes)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 6, 7, 8, 9]


# --- op 2 -------------------------------------------------------------------------------------------------------------

def _tokens(docs_rows, counter):
    total = {}
    for (source, lang), text in docs_rows:
        key = (source, lang)
        n, t = total.get(key, (0, 0))
        total[key] = (n + 1, t + counter(text))
    return total


def test_token_rollup_against_counting_what_is_left(spark, docs):
    import tiktoken

    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.read_ranks(), special_tokens={})
    rows = sorted(docs.select("doc_id", "source", "lang", "text").collect(), key=lambda r: r["doc_id"])
    seen, left = set(), []
    for r in rows:
        if r["text"] not in seen:
            seen.add(r["text"])
            left.append(((r["source"], r["lang"]), token_counts.without_repeated_lines(r["text"])))
    got = {}
    for r in queries.op2_token_rollup(spark, SF).collect():
        got.setdefault(r["tokenizer_version"], {})[r["source"], r["lang"]] = (r["n_docs"], r["n_tokens"])
    assert got["whitespace_1"] == _tokens(left, lambda t: len(t.split()))
    assert got["byte_bpe_50k"] == _tokens(left, lambda t: len(encoding.encode_ordinary(t)))


def test_bpe_counts_of_odd_white_space():
    import tiktoken

    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.read_ranks(), special_tokens={})
    count = token_counts.bpe_counter(token_counts.read_ranks())
    rng = np.random.default_rng(3)
    odd = ["".join(rng.choice(list("ab1.' \n\t\xa0 　\x1cé"), rng.integers(0, 30))) for _ in range(500)]
    assert count(odd) == [len(encoding.encode_ordinary(t)) for t in odd]


def test_rollup_commits_once_and_compacts(spark, tmp_path):
    ddl = "source string, lang string, tokenizer_version string, n_before long, n_after long"
    store = token_counts.Rollup(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    first = token_counts.signed_changes(frame(spark, [("a", "en", "v", None, 5), (None, "en", "v", None, 7), ("a", "en", "v", None, 1), ("b", None, "v", 3, 3)], ddl))
    second = token_counts.signed_changes(frame(spark, [("a", "en", "v", 5, 4), (None, "en", "v", 7, None)], ddl))
    assert store.commit("1", first) and not store.commit("1", first)
    # a batch that broke off before its marker leaves rows that do not count
    second.selectExpr("source", "lang", "tokenizer_version", "sign n_docs", "n_tokens").write.parquet(str(tmp_path / "store/deltas/2"))
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "v", 2, 6), (None, "en", "v", 1, 7)}
    assert store.commit("2", second)
    want = {("a", "en", "v", 2, 5)}
    assert {tuple(r) for r in store.totals().collect()} == want
    store.compact()
    assert not store.commit("2", second) and {tuple(r) for r in store.totals().collect()} == want
    store.commit("3", first)
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "v", 4, 11), (None, "en", "v", 1, 7)}
    with pytest.raises(Exception, match="sign"):
        store.commit("4", frame(spark, [("a", "en", "v", 2, 1)], "source string, lang string, tokenizer_version string, sign int, n_tokens long"))


# --- op 3 -------------------------------------------------------------------------------------------------------------

def test_leaks_equal_brute_force(spark, docs, texts):
    bench = read_table(spark, SF, "benchmark")
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda t: [tuple(w[k:k + 5]) for w in [words(t)] for k in range(len(w) - 4)]
    items = {r["item_id"]: grams(r["text"]) for r in bench.collect()}
    of = {}
    for i, g in items.items():
        for x in g:
            of.setdefault(x, set()).add(i)
    want = set()
    for d, t in texts.items():
        held = set(grams(t))
        for i in {i for x in held for i in of.get(x, ())}:
            if sum(x in held for x in items[i]) >= 0.8 * len(items[i]):
                want.add((d, i))
    got = decontamination.leaks(docs, bench).collect()
    assert want and {(r["doc_id"], r["item_id"]) for r in got} == want
    assert decontamination.clean(docs, bench).count() == len(texts) - len({d for d, _ in want})


def test_reparameterised_questions(spark):
    item = "Tom has 3 apples and buys 5 kg of flour for Tom from the market near Paris today"
    swap = lambda a, n, m, u, b, c: f"intro words. {a} has {n} apples and buys {m} {u} of flour for {b} from the market near {c} today ok"
    rows = [(1, swap("Bob", 7, 9, "lb", "Bob", "Rome")), (2, swap("Bob", 7, 9, "lb", "Ann", "Rome")), (3, item.upper()), (4, None), (5, ""),
            (6, "Bob has 7 apples"), (None, item), (7, "nothing of the kind is written here by Ann in Rome")]
    df = frame(spark, rows).withColumn("item_id", F.lit(1))
    bench = frame(spark, [(10, item), (10, item), (11, "too short"), (12, None), (13, "1 2 3 4 5 6 7 8 9")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontamination.leaks(df, bench, names=["Tom", "Bob", "Ann"]).collect()}
    assert got == {(1, 10): "template", (3, 10): "exact"}
    assert sorted(str(r["doc_id"]) for r in decontamination.clean(df, bench, names=["Tom", "Bob", "Ann"]).collect()) == ["2", "4", "5", "6", "7", "None"]
    assert decontamination.leaks(df.limit(0), bench).count() == 0 == decontamination.leaks(df, bench.limit(0)).count()


def test_reparameterised_questions_of_other_token_counts(spark):
    item = "the old baker from Paris sold 48 loaves of dark bread to a school near the river and then packed another 48 loaves for them"
    more = lambda t: t.replace("and then", "and soon then")
    rows = [(1, item.replace("Paris", "New York")), (2, item.replace("48", "sixty five")), (3, more(item).replace("48", "9")),
            (4, item.replace("48", "sixty five", 1)), (5, more(item).replace("Paris", "New York").replace("48", "seventy two")),
            (6, more(item).replace("48", "9", 1)), (7, more(item))]
    got = {r["doc_id"]: r["kind"] for r in decontamination.leaks(frame(spark, rows), frame(spark, [(1, item)], "item_id long, text string")).collect()}
    assert got == {1: "template", 2: "template", 3: "template", 5: "template", 7: "exact"}


def test_reparameterised_names_that_open_sentences(spark):
    item = ("Natalia sold clips to many of the friends in the town. Natalia then paid for a cake with all of it. "
            "How much of the money was left in the end?")
    rows = [(1, "Question: " + item.replace("Natalia", "Emma")), (2, item.replace("Natalia", "Emma", 1).replace("Natalia", "Ruth")),
            (3, "so " + item.replace("Natalia", "Emma Lou")), (4, item.lower())]
    got = {r["doc_id"]: r["kind"] for r in decontamination.leaks(frame(spark, rows), frame(spark, [(1, item)], "item_id long, text string")).collect()}
    assert got == {1: "template", 3: "template", 4: "exact"}


def test_short_unspaced_and_arithmetic_items_leak_word_for_word(spark):
    bench = ["Name the capital!", "12 + 7 * 3 = 33", "中国的首都是哪个城市?", "你好吗", "1 2 3 4 5 6 7", "?!", "เมืองหลวงของไทย", "yes"]
    rows = ["so name the capital. name the capital", "is 12 + 7 * 3 = 33 or", "他问:中国的首都是哪个城市?我说不知道。", "他说你好吗。", "0 1 2 3 4 5 6 7 8", "?! the capital",
            "ถามว่าเมืองหลวงของไทยคืออะไร", "12 7 3", "name capital yesterday", "Yes, yes", "你好"]
    got = decontamination.leaks(frame(spark, list(enumerate(rows))), frame(spark, list(enumerate(bench)), "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["kind"], r["containment"]) for r in got) == [
        (d, i, "exact", 1.0) for d, i in ((0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (6, 6), (9, 7))]


def test_parameterisations_of_one_question_are_one_class(spark):
    """200 items of one template against 200 documents: rows for documents plus items, which stand for all pairs."""
    ask = lambda a, b: f"a farmer packs {a} apples into every box and then sells {b} boxes on the market before noon"
    items = [(k, ask(100 + k, 1000 + k)) for k in range(200)]
    docs = [(k, f"intro {k} here: " + ask(5000 + k, 9000 + k)) for k in range(199)] + [(199, "so " + items[7][1])]
    got = decontamination.leaks(frame(spark, docs), frame(spark, items, "item_id long, text string"))
    rows = got.collect()
    assert len(rows) <= 2 * (len(docs) + len(items)) and len({r["class_id"] for r in rows}) == 2
    pairs = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontamination.every_pair(got).collect()}
    assert set(pairs) == {(d, i) for d in range(200) for i in range(200)}
    assert [p for p, kind in pairs.items() if kind == "exact"] == [(199, 7)]


def test_template_matches_equal_brute_force(spark):
    """Random re-parameterisations, with values that must repeat, behind a prompt that all items and documents share."""
    rnd = random.Random(5)
    words = [a + b for a in "bcdfgklmnprstvz" for b in ("aro", "elin", "ivor", "otun", "uma")]
    prompt = "read the task with care and give a short answer"
    templates = []
    for _ in range(6):
        body = rnd.sample(words, 30)
        slots = [rnd.randrange(3) for _ in range(4)]  # which value stands where
        templates.append((body, slots))

    def fill(t, values, free):
        body, slots = templates[t]
        out, used = list(body), []
        for k, s in enumerate(slots):
            used.append(rnd.randrange(10, 99) if free else values[s])
            out.insert(6 + 7 * k, str(used[-1]))
        return f"{prompt} {' '.join(out)}", used

    items, docs = [], []
    for k in range(60):
        t = rnd.randrange(6)
        text, used = fill(t, [rnd.randrange(10, 14) for _ in range(3)], False)
        items.append((k, text, t, used))
    for k in range(120):
        t = rnd.randrange(6)
        text, used = fill(t, [rnd.randrange(10, 99) for _ in range(3)], k % 3 == 0)
        docs.append((k, text, t, used))
    docs.append((500, prompt, -1, []))
    got = decontamination.leaks(frame(spark, [d[:2] for d in docs]), frame(spark, [i[:2] for i in items], "item_id long, text string"))
    have = {(r["doc_id"], r["item_id"]) for r in decontamination.every_pair(got).collect()}
    want = set()
    for d, _, t, values in docs:
        for i, _, u, own in items:
            consistent = len(set(zip(own, values))) == len(set(own))
            literal = sum(x != y for x, y in zip(own, values)) <= 1  # 35 of the 40 windows; two other values leave 30
            if t == u and (consistent or literal):
                want.add((d, i))
    assert have == want and len(want) > 100
    assert len({r["class_id"] for r in got.collect()}) < len(items)


# --- op 4 -------------------------------------------------------------------------------------------------------------

def test_warc_records_link_and_read_back(spark):
    pages = read_table(spark, SF, "pages")
    responses = warc.responses_of(pages, "2024-01-01T00:00:00Z")
    records = warc.build(responses)
    rows = records.collect()
    blocks = {r["source_id"]: bytes(r["block"]) for r in responses.collect()}
    assert len(rows) == 2 * len(blocks) and len({r["record_id"] for r in rows}) == len(rows)
    for r in rows:
        payload = blocks[r["source_id"]].partition(b"\r\n\r\n")[2]
        assert r["payload_digest"] == warc.digest(payload) and r["block_digest"] == warc.digest(r["block"].encode())
        assert r["content_length"] == len(r["block"].encode()) and f"WARC-Refers-To: {r['refers_to']}" in r["header"]
    by = {}
    for r in rows:
        by.setdefault(r["source_id"], {})[r["record_type"]] = r["refers_to"]
    assert all(set(x) == {"metadata", "conversion"} and len(set(x.values())) == 1 for x in by.values())
    data = b"".join(bytes(r["record"]) for r in warc.record_bytes(records).collect())
    parsed = [(dict(h)["WARC-Record-ID"], b.decode()) for h, b in warc.parse(data)]
    assert sorted(parsed) == sorted((r["record_id"], r["block"]) for r in rows)


def test_warc_edges(spark):
    ddl = "source_id long, record_id string, target_uri string, warc_date string, block binary, header string"
    rows = [(1, None, None, None, None, "x"), (2, "<urn:uuid:1>", "http://a/", None, b"HTTP/1.1 200 OK\r\nX-A: b\r\n c\r\n\r\n<p>a &lt; b</p>", None),
            (3, "<r>", "u", "d", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=none\r\n\r\n<title>t</title><p>a &lt; b<script>x</script>", None)]
    got = {(r["source_id"], r["record_type"]): r for r in warc.build(frame(spark, rows, ddl)).collect()}
    assert len(got) == 6 and got[2, "metadata"]["refers_to"] == "<urn:uuid:1>" and "header-x-a: b c" in got[2, "metadata"]["block"]
    assert got[3, "conversion"]["block"] == "t\na < b" and got[1, "conversion"]["block"] == ""


def test_warc_text_of_unclosed_elements():
    text = lambda page: warc.plain_text(page.encode(), "text/html")
    for page in ("<html><head><title>t</title><body><p>hello world</p>", "<head><meta charset=u><title>t</title><script>'<p>'</script>hello <b>world</b>",
                 "<head><!-- <p> --><style>p{}</style><p>hello world", "<noscript><p>hello world</p>", "hello <template>world",
                 "<HEAD><TITLE>t</TITLE><noscript><p>no</p></noscript>\n</HEAD >hello world<script>x", "<script>'<head>'</script>hello world<!-- x",
                 "<head>\n<link rel=x><title>t</title>\n<header>hello world</header>"):
        assert text(page).split() == ["hello", "world"], page


# --- op 5 -------------------------------------------------------------------------------------------------------------

def test_url_filter_against_brute_force(spark):
    rng = np.random.default_rng(4)
    label = lambda: str(rng.choice(["a", "b", "co", "a-b", "x"]))
    host = lambda: ".".join(label() for _ in range(rng.integers(1, 4)))
    path = lambda: "".join(f"/{label()}" for _ in range(rng.integers(0, 3)))
    urls = [f"http://{host()}{path()}" + str(rng.choice(["", "?q=/a", "#/b"])) for _ in range(600)] + ["HTTP://A.CO/a"] * 400
    urls += [None, "", "a.co/a", "://a.co", "http://", "x://a.co://b/a", "http:///a"]
    rules = sorted({(host(), path() + "/", str(rng.choice(["allow", "block"]))) for _ in range(30)} | {("", "/a", "block"), ("co", "", "allow")})
    unique = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    df = frame(spark, list(enumerate(urls)), "page_id long, url string").withColumn("range", F.lit(1)).withColumn("host", F.lit("z"))

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        h, p = m[1].lower(), m[2]
        fits = [(len(a) + len(b), v == "block", a + b, v) for a, b, v in unique if (not a or h == a or h.endswith("." + a)) and p.startswith(b)]
        if not fits:
            return h, p, None, "allow"
        top = max(f[:2] for f in fits)
        best = min(f[2:] for f in fits if f[:2] == top)
        return (h, p, *best)
    for ranges in (1, 7):
        got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(df, url_filter.rule_table(spark, unique), ranges=ranges).collect()}
        assert got == {k: brute(u) for k, u in enumerate(urls)}
    assert url_filter.judge(df.limit(0), url_filter.rule_table(spark)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(df, url_filter.rule_table(spark).limit(0)).collect()} == {"allow"}


# --- op 6 -------------------------------------------------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_quality(spark, sf).join(read_table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in got])
    assert len(got) > 500 and right > 0.98


def test_trees_and_edges(spark, docs):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, quality.N_STATISTICS))
    y = ((x[:, 3] > 0.2) ^ (x[:, 7] > 0)).astype(float)
    model = quality.boost(x, y)

    def walk(row):
        total = model.base
        for k in model.roots:
            while model.feature[k] >= 0:
                k = model.left[k] if row[model.feature[k]] <= model.threshold[k] else model.right[k]
            total += model.value[k]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(model.predict(x[:50]), [walk(r) for r in x[:50]])
    assert np.mean((model.predict(x) > 0.5) == (y > 0)) > 0.95
    none = quality.fit(docs, frame(spark, [(None, 1), (3, None)], "doc_id long, quality int"))
    odd = frame(spark, [(1, None), (2, ""), (None, "a"), (2, ""), (4, "é" * 50_000)]).withColumn("score", F.lit("clash"))
    assert [r["score"] for r in quality.scores(odd, none).collect()] == [0.5] * 5
    assert quality.accepted(odd, none).columns == odd.columns and quality.accepted(odd, none).count() == 5
    assert quality.scores(odd.limit(0), none).count() == 0


# --- op 7 -------------------------------------------------------------------------------------------------------------

def test_main_text_of_the_pages(spark):
    import html as entities

    def plain(page):
        a = page.index("<article>") + 9
        body = page[a:page.find("</article>") if "</article>" in page else len(page)]
        return " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())
    pages = read_table(spark, SF, "pages")
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_main_text_without_an_article_element():
    para = "A paragraph of some length that carries the text of the page, word after word."
    page = (f"<html><head><title>t</title><style>p{{}}</style></head><body><header><p>{para}</p></header><div id='main-menu'><a href=x>{para}</a></div>"
            f"<ul><li><a href=1>one</a><li><a href=2>two</a></ul><div><h1>Head</h1><p>{para} a&nbsp;&lt; b<!-- no --><script>if(a<b){{'</p>'}}</script></p>"
            f"<div class='ad-box'>{para}</div><p>{para}<b>bo</b>ld<br>x</p></div><section class='comments'><p>{para}</p></section><form>{para}<input></form><p hidden>{para}")
    assert html_text.main_text(page) == f"Head {para} a < b {para}bold x"


def test_main_text_keeps_links_of_the_article():
    page = ("<body><ul><li><a href=0>menu</a></ul><article><h1><a href=1>Title</a></h1><nav><a href=2>menu</a></nav><p><a href=3>A linked paragraph.</a> Yes.</p>"
            "<p>Text.</p><ul><li><a href=4>Source</a></ul></article><p><a href=5>more</a></p>")
    assert html_text.main_text(page) == "Title A linked paragraph. Yes. Text. Source"


def test_main_text_keeps_all_runs_of_the_container():
    long, closing = "A long paragraph of the text. " * 30, "The closing words of the page, of some length."
    ad, side = "<div class=ad>Buy this</div>", "<div><p>Weather: sun.</p><p>Tides: low.</p></div>"
    want = f"{long.strip()} {closing}"
    for page in (f"<body>{side}{ad}<div><p>{long}</p>{ad}<p>{closing}</p></div>{ad}{side}", f"<div><section><p>{long}</p></section>{ad}<section>{closing}</section></div>{ad}{side}",
                 f"<div><div>{long}</div>{ad}<div>{closing}</div></div>{ad}{side}", f"<div><ul><li>{long}<li>{ad}</ul><p>{closing}</div>"):
        assert html_text.main_text(page) == want, page
    assert html_text.main_text("<body><div class=menu>Home</div><div><h1>Short</h1><p>text</p></div>") == "Short text"
    assert html_text.main_text("<div>y" * 5000).count("y") == 5000


def test_main_text_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>"), (4, "u", "no markup but enough text to count as the main text of a page"), (5, "u", "<article><p>x</article"),
            (6, "u", "<article>" + "<div>y" * 5000), (6, "u", "<a 'b")]
    got = html_text.extract(frame(spark, rows, "page_id long, url string, html string").withColumn("text", F.lit(0))).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, 0), (2, 0), (3, 0), (4, 61), (5, 1), (6, 0), (6, 9999)]


# --- op 8 -------------------------------------------------------------------------------------------------------------

def _best(tables, word):
    """Plain Viterbi over a dictionary of pieces."""
    scores = {p.replace(" ", pieces.MARK): s for p, s in ((o.decode("utf-8", "replace"), tables.scores[i]) for i, o in enumerate(tables.out) if i not in tables.byte_ids and o)}
    best = [0.0] + [None] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            s = scores.get(word[i:j])
            if s is None and j == i + 1:
                s = tables.unknown
            if s is not None and (best[j] is None or best[i] + s > best[j]):
                best[j] = best[i] + s
    return best[-1]


def test_piece_segmentations_are_the_best(texts):
    with open(pieces.MODEL, "rb") as file:
        tables = pieces.Tables(file.read())
    encoder = pieces.Encoder(tables)
    words = sorted({w for t in list(texts.values())[:40] for w in t.split()})[:400] + ["日本語", "x😀y", "a" * 90, "naïve▁"]
    ids, ends = encoder.ids([w.encode() for w in words])
    of_byte = {i: b for b, i in enumerate(tables.bytes)}
    for k, word in enumerate(words):
        own = ids[ends[k]:ends[k + 1]].tolist()
        score = 0.0
        for i in own:  # the byte pieces of an unknown character count once
            byte = of_byte.get(i)
            score += tables.scores[i] if byte is None else tables.unknown if byte < 0x80 or byte >= 0xC0 else 0.0
        assert score == pytest.approx(_best(tables, pieces.MARK + word)), word


def test_long_unspaced_texts_take_linear_time_and_bounded_memory():
    import time

    with open(pieces.MODEL, "rb") as file:
        encoder = pieces.Encoder(pieces.Tables(file.read()))
    took = []
    for n in (100_000, 2_000_000):
        text = ("\u65e5\u672c\u8a9e\u306e\u6587\u7ae0" * (n // 6)).encode()
        began = time.process_time()
        ids, ends = encoder.ids([text])
        took.append(time.process_time() - began)
        assert len(ids) == ends[-1] > n // 4
    assert took[1] < 40 * took[0] + 5
    encoder.ids([b"x"] + [(f"\u65e5{k} " * 3).encode() for k in range(9)])
    assert encoder.held <= pieces.MEMO_BYTES  # the long ones are forgotten


def test_piece_ids_agree_with_the_public_library(texts):
    import sentencepiece

    with open(pieces.MODEL, "rb") as file:
        raw = file.read()
    tables = pieces.Tables(raw)
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(raw + b"\x12\x02\x18\x01")  # the same pieces as a unigram model
    encoder = pieces.Encoder(tables)
    for word in sorted({w for t in list(texts.values())[:60] for w in t.split()})[:500]:
        ids, _ = encoder.ids([word.encode()])
        theirs = library.nbest_encode_as_ids(word, 2)[0]
        score = lambda x: sum(tables.scores[i] for i in x)
        assert score(ids.tolist()) >= score(theirs)


def test_piece_round_trip(spark, docs):
    model = pieces.Model(spark)
    rows = [(1, None), (2, ""), (3, "  a  b \n\n\tc "), (4, "日本 😀 é"), (5, "▁a"), (6, "x" * 100_000), (6, "same"), (None, "no id"), (7, " ")]
    got = {(r["doc_id"], r["n_decoded"]): r for r in pieces.round_trip(frame(spark, rows).withColumn("ids", F.lit("clash")), model).collect()}
    assert len(got) == 9 and all(r["round_trip"] == (k[0] != 5) for k, r in got.items()) and got[1, 0]["ids"] == []
    assert pieces.round_trip(docs, model).filter("not round_trip").count() == 0
    enc = pieces.encode(docs, model)
    dec = pieces.decode(enc, model).join(docs.select(F.col("doc_id").alias("d"), "text"), F.col("doc_id") == F.col("d"))
    assert dec.filter("decoded <> text").count() == 0
    odd = frame(spark, [(1, [None, -5, 10**6, model.tables.bytes[0xE9]]), (2, None)], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in pieces.decode(odd, model).collect()} == {1: "�", 2: ""}


# --- op 9 -------------------------------------------------------------------------------------------------------------

def _groups(fps: dict, radius=3):
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_fingerprints_by_definition(texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for t in [*list(texts.values())[:80], "", " \n", "One", "ÀB cd\x0bE", "a b c"]:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(low))
        sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
        assert simhash.fingerprint(t.encode()) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("tile", [5, 4096])
def test_links_find_every_component(spark, tile):
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = [int(c) for c in centres] + [0, 2**64 - 1, 7]
    for c in centres[:20]:
        at = int(c)
        for _ in range(12):  # chains of steps of up to three bits
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                at ^= 1 << int(b)
            fps.append(at)
    fps = sorted({f - 2**64 if f >= 2**63 else f for f in fps})
    edges = simhash.link_edges(frame(spark, [(f,) for f in fps], "fp long"), 3, tile)
    root = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = _groups({f: f % 2**64 for f in fps})
    assert {f: root.get(f, f) for f in fps} == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    got = {r["node"]: r["root"] for r in components.components(frame(spark, [*path, *star, (5, 5), (7, 6), (None, 3)], "u long, v long")).collect()}
    assert got == {k: 0 for k in range(1, 201)} | {1000 + k: 1000 for k in range(1, 300)}
    assert components.components(frame(spark, [], "u long, v long")).count() == 0


def test_simhash_edges(spark):
    base = " ".join(f"w{k}" for k in range(3000))
    rows = [(9, base), (4, base + " tail"), (2, None), (1, ""), (None, " "), (7, "One Two"), (8, "one  two"), (8, "one  two")]
    df = frame(spark, rows).withColumn("fp", F.lit("clash"))
    got = [(r["doc_id"], r["component_id"]) for r in simhash.components_of(df).collect()]
    assert sorted(got, key=str) == sorted([(9, 4), (4, 4), (2, 1), (1, 1), (None, 1), (7, 7), (8, 7), (8, 7)], key=str)
    kept = simhash.survivors(df)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "7", "None"]
    assert simhash.components_of(df.limit(0)).count() == 0


# --- op 10 ------------------------------------------------------------------------------------------------------------

RX = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
      "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in hit.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]


def _base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k in RX for m in re.finditer(RX[k], text or "") if _valid(k, m[0])]


def test_base_spans_by_definition(spark, texts):
    import random

    rng = random.Random(5)
    odd = ["", None, "a@b.c_d@e.f, x@y@z.com 1.2.3.4.5 300.1.1.1 001.2.3.4 +1 (017) 555-7713.", "4111 1111 1111 1111 4111-1111-1111-1112  4111111111111111 1",
           "é😀 a@b.co +49 30 1234567", "1" * 3000, "1 " * 3000]
    odd += ["".join(rng.choice("ab1.@+-( )49é ") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    odd += list(texts.values())[:300]
    df = frame(spark, list(enumerate(odd))).withColumn("row", F.lit("clash")).withColumn("kind", F.lit(1)).repartition(4)
    got = {r["doc_id"]: r for r in pii.digest(pii.extract(df)).collect()}
    assert len(got) == len(odd)
    for k, text in enumerate(odd):
        want = _base(text)
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [got[k][f"n_{x}"] for x in RX] == [sum(w.startswith(x) for w in want) for x in RX]
        assert [s for s in got[k]["spans"].split(",") if s and not s.startswith("context_")] == want


def test_context_finds_unseen_identifiers_only_by_sure_patterns(spark):
    rows = [f"Please call tel no {n} now or write" for n in ("+1 (017) 555-7713", "+49 30 123 45 67", "+44 20 7946 0958", "+1 212 555 0199", "(030-1234567),")]
    rows += ["lost pin no 77 here", "two of the 4 are free", None, "same +1 (017) 555-7713 words", "same +1 (017) 555-7713 words", "same 12345 words"]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, list(enumerate(rows))))).collect()}
    assert got[4] == "context_phone:20:31" and rows[4][20:31] == "030-1234567"
    assert all("context" not in s for k, s in got.items() if k != 4)
    assert pii.digest(pii.extract(frame(spark, []))).count() == 0


def test_context_finds_identifiers_with_spaces_and_behind_numbers(spark):
    phones = ("+1 (017) 555-7713", "+49 30 123 45 67", "+44 20 7946 0958", "+1 212 555 0199")
    rows = [f"Please call tel no {n} now or write" for n in (*phones, "030 123 4567")] + [f"and line no 2 {n} too" for n in (*phones, "030-1234567")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, list(enumerate(rows))))).collect()}
    assert got[4] == "context_phone:19:31" and rows[4][19:31] == "030 123 4567"
    assert "context_phone:14:25" in got[9].split(",") and rows[9][14:25] == "030-1234567"


def test_found_identifiers_are_seeds_of_the_next_round(spark):
    phones, unseen = [f"+49 30 123 45 {k}" for k in range(60, 68)], [f"030-{k}" for k in range(1111, 1115)]
    rows = [f"please dial {n}" for n in (*phones, *unseen)] + [f"or fax {n}" for n in (*unseen, "0177-9999")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, list(enumerate(rows))))).collect()}
    assert got[16] == "context_phone:7:16" and got[8] == "context_phone:12:20"


def test_pii_is_native(spark, docs):
    plan = pii.spans(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
