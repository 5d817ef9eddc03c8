"""Language ID, decontamination, URL rules, HTML extraction and token counts on small cases."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import documents, random_texts

from huntlake.llm import decontaminate, language, pages, queries, separators, tokens, url_rules
from huntlake.sinks.shared import fresh_folder

ENGLISH = "the quick brown fox jumps over the lazy dog while they were watching from the other side of this river"
GERMAN = "der schnelle braune fuchs springt über den faulen hund während sie von der anderen seite zuschauen und schweigen"


def labelled(spark):
    rows = []
    for i in range(40):
        words = (ENGLISH, GERMAN)[i % 2].split()
        rows.append((i, " ".join(words[i % 5 :] + words[: i % 7]), ("en", "de")[i % 2]))
    return documents(spark, rows)


def test_language(spark):
    filters = language.fit(labelled(spark))
    assert filters.languages == ("de", "en")
    rows = [(1, "They were WATCHING the river!"), (2, "Während sie schweigen..."), (3, None), (4, ""), (5, "12 %% \n"), (6, "ж"), (7, "ω" * 9)]
    rows += [(1, "They were WATCHING the river!"), (None, "the other side")]
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in language.predict(documents(spark, rows), filters).collect()}
    assert {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en")} <= set(got)
    assert all(0 <= score <= 1 for score in got.values()) and got[1, "en"] > 0.8
    kept = language.accepted(documents(spark, rows), filters)
    assert kept.columns == documents(spark, []).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 1, 2, None], key=str)


def test_language_without_labels(spark):
    filters = language.fit(documents(spark, [(1, "text", None), (2, None, "en")]))
    assert filters.languages == ()
    assert language.predict(documents(spark, [(1, "text")]), filters).first()["lang_pred"] == "und"


def test_grams_of_a_long_text_are_those_of_its_parts(monkeypatch):
    text = "Some  words, and MORE of them " * 30
    whole = np.concatenate(list(language.gram_hashes(text)))
    monkeypatch.setattr(language, "CHUNK", 37)
    assert sorted(np.concatenate(list(language.gram_hashes(text))).tolist()) == sorted(whole.tolist())


def test_masks_are_looked_up_for_all_languages_at_once():
    masks = np.zeros(1 << 12, np.uint64)
    hashes = np.concatenate(list(language.gram_hashes("words")))
    for slot in language.slots_of(hashes, len(masks)):
        masks[slot] |= np.uint64(0b101)
    total, found = language.Filters(masks, ("a", "b", "c")).counts("words")
    assert total == len(hashes) and found.tolist() == [total, 0, total]


def contained(rows, items, least=0.8):
    def words(text):
        return (text or "").lower().encode().split()

    def shingles(text, width):
        return {tuple(words(text)[i : i + width]) for i in range(len(words(text)) - width + 1)}

    best: dict[tuple, tuple] = {}
    for doc_id, text in rows:
        for item_id, item in items:
            width = min(5, len(words(item)))  # a shorter item is one shingle
            wanted = shingles(item, width) if width else set()
            shared = len(wanted & shingles(text, width)) if wanted else 0
            if wanted and shared >= least * len(wanted) - 1e-9:
                found = (shared / len(wanted), shared, len(wanted))
                best[doc_id, item_id] = max(best.get((doc_id, item_id), found), found)
    return {key: value[1:] for key, value in best.items()}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_decontamination(spark, settings, threshold):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold)
    texts = random_texts(5, 40, 12, 60)
    items = [(i, " ".join(text.split()[3:20]).upper()) for i, text in enumerate(texts[:12])]
    items += [(50, None), (51, ""), (52, "too short"), (0, items[0][1]), (53, "a b c d e a b c d e")]
    rows = [(i, text) for i, text in enumerate(texts)] + [(90, None), (91, ""), (None, texts[0]), (3, "other text"), (5, texts[5])]
    rows += [(92, "x a b c d e a b c d e y")]
    df = spark.createDataFrame([(*item, 1, "x") for item in items], "item_id long, text string, tag int, need string")
    got = decontaminate.contamination(documents(spark, rows), df).collect()
    expected = contained(rows, items)
    assert {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_shingles"]) for r in got} == expected and len(got) == len(expected) > 10
    clean = decontaminate.clean(documents(spark, rows), df).collect()
    bad = {doc_id for doc_id, _ in expected}
    assert {r["doc_id"] for r in clean} == {doc_id for doc_id, _ in rows} - bad | {3} & {r["doc_id"] for r in clean}
    assert any(r["text"] is None for r in clean)
    assert decontaminate.contamination(documents(spark, []), df).collect() == []
    assert decontaminate.contamination(documents(spark, rows), df.limit(0)).collect() == []


RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
    ("block", "Part.org", "/fr/ab"), ("allow", "whole.org", ""), ("block", None, "/"), ("block", "same.org", "/x"), ("allow", "same.org", "/x"),
]


def judged(url):
    head, mark, tail = (url or "").partition("://")
    rest = tail if mark else ""
    cut = min([at for at in map(rest.find, "/?#") if at >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([at for at in map(path.find, "?#") if at >= 0], default=len(path))]
    fits = [
        (len(h) + len(p), len(h), verdict == "block", h.lower() + p, verdict)
        for verdict, h, p in RULES
        if h is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    return host, path, *(max(fits)[3:] if fits else (None, "allow"))


def test_url_rules(spark):
    urls = [
        None, "", "no scheme/en/", "http://a.example.net/en/1?x=://b", "HTTP://A.EXAMPLE.NET/de/1", "http://example.net", "http://net/",
        "http://notexample.com/de/1", "http://example.com/de/", "http://x.org/fr/1#/de/", "http://q.part.org/fr/abc", "http://part.org/fr/a",
        "http://whole.org?x", "http://whole.org/fr/x", "http://same.org/xy", "http:///de/", "http://É.net/é", "http://a.net:80/x", "x://y://z.net/",
        "http://" + "a." * 3000 + "net" + "/b" * 3000, "http://a.net/\nb?c", "http://.net/", "http://net./",
    ]
    rows = [(i, url, 1, "x") for i, url in enumerate(urls)] + [(None, urls[3], 1, "x"), (3, urls[3], 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host int, rule string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    got = url_rules.judge(df, rules).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((row[0], *judged(row[1])) for row in rows), key=str)
    assert {r["verdict"] for r in url_rules.judge(df, rules.limit(0)).collect()} == {"allow"}
    assert url_rules.judge(df.limit(0), rules).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><article>x";</script></head><body class="page">
<nav><ul><li>Menu</ul></nav><div class="ad banner">Buy <div>now</div> today</div>{open}
<article><h1>Head &amp; tail</h1><p><b>One&nbsp;two</b>three<br>four <p>five&#33; &am<aside>side</aside><div id='comments'>reader</div>
<form>field</form><!-- hidden --> six</article> after <footer>&copy; site</footer>"""


def test_blocks_of_a_page():
    found = pages.blocks(PAGE.format(open="loose"))
    assert " ".join(text for kind, text in found if kind == "keep") == "Head & tail One twothree four five! &am six"
    assert [text for kind, text in found if kind == "open"] == ["loose", "after"]
    assert pages.blocks("") == [] and pages.blocks("a < b <i>c</i> </p> d <p e") == [("open", "a < b c"), ("open", "d")]
    assert pages.blocks("<script>x") == [] and len(pages.blocks("<p>x" * 20000)) == 20000


def test_repeated_runs_go_where_markup_tells_nothing(spark):
    notice = "this site uses small files to remember your visit"
    rows = [(i, f"http://h{i % 2}.org/{i}", f"<p>{notice}</p><p>own words of page {i} are kept here</p>") for i in range(6)]
    rows += [(10, "http://h0.org/10", PAGE.format(open=notice)), (11, None, None), (12, "", ""), (13, "http://alone.org/", f"<p>{notice}")]
    rows += [(14, "http://twin.org/", "<p>one page that stands there twice is one page")] * 2 + [(None, None, "<p>x")]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "page_id long, url string, html string, text string, key int")
    got = {r["page_id"]: r["text"] for r in pages.main_text(df).collect()}
    assert len(pages.main_text(df).collect()) == len(rows)
    for i in range(6):
        assert got[i] == f"own words of page {i} are kept here"
    assert got[10] == "Head & tail One twothree four five! &am six"
    assert got[11] == got[12] == "" and got[13] == notice and got[14].startswith("one page") and got[None] == "x"
    assert pages.main_text(df.limit(0)).collect() == []


def test_copies_and_shared_phrases_stay(spark):
    own = "the only text of a page that is stored under many ids and urls of one host"
    phrase = "a passage of more than nine words that two posts of the host quote"
    rows = [(i, f"http://copies.org/{i}", f"<nav>seen {i} times</nav><p>{own}") for i in range(5)]
    rows += [(10 + i, "http://copies.org/same", f"<p>{own}") for i in range(2)]
    rows += [(20 + i, f"http://quotes.org/{i}", f"<p>{phrase}<p>post {i}") for i in range(2)]
    rows += [(30 + i, f"http://short.org/{i}", f"<p>{i} it goes without saying that {i}") for i in range(6)]
    rows += [(40 + i, url, f"<p>{phrase} {i}") for i, url in enumerate([None, "", "no/scheme", "other", None, "http:///x"])]
    rows += [(100 + i, f"http://large.org/{i}", f"<p>{phrase if i < 3 else ''} text {i}</p><p>{own}</p>") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.main_text(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == own for i in (*range(5), 10, 11))
    assert all(got[20 + i] == f"{phrase} post {i}" for i in range(2))
    assert all(got[30 + i] == f"{i} it goes without saying that {i}" for i in range(6))
    assert all(got[40 + i] == f"{phrase} {i}" for i in range(6))
    assert all(got[100 + i] == (f"{phrase} text {i}" if i < 3 else f"text {i}") for i in range(200))


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_token_counts(spark, block):
    texts = [None, "", "one", "two words", "three more words", ""] + random_texts(9, 20, 9, 40)
    df = spark.createDataFrame([(i, f"s{i % 3}", text) for i, text in enumerate(texts)], "place long, shard string, text string").repartition(3, "shard")
    path = fresh_folder(spark, "flat")
    separators.write_flat(df, path)
    got = separators.count_tokens(spark, path, block).withColumn("shard", F.regexp_extract("file", "shard=([^/]*)", 1)).collect()
    for shard in range(3):
        mine = sorted((r for r in got if r["shard"] == f"s{shard}"), key=lambda r: r["ordinal"])
        assert [r["ordinal"] for r in mine] == list(range(len(mine))) and all(r["closed"] for r in mine)
        assert [r["n_tokens"] for r in mine] == [len(tokens.ids_of(t)) // 4 for t in texts[shard::3]]


def test_blocks_are_read_by_themselves_from_files_of_any_name(spark, tmp_path):
    end = separators.END
    ids = (np.arange(1000) % 50).astype(">u2")
    ids[[99, 100, 640]] = end
    for name in ("plain", "100%25 sure: a b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "ids.txt").write_bytes(ids.tobytes())
    ranges = separators.block_ranges(spark, str(tmp_path), 64)
    assert ranges.columns == ["file", "block", "bytes"] and ranges.count() == 32
    assert separators.block_ranges(spark, str(tmp_path), 1).rdd.getNumPartitions() == -(-2000 // separators.TASK_BLOCKS)
    got = separators.count_tokens(spark, str(tmp_path), 64).collect()
    assert sorted((r["ordinal"], r["n_tokens"], r["closed"]) for r in got) == sorted(
        2 * [(0, 99, True), (1, 0, True), (2, 539, True), (3, 359, False)]
    )


@pytest.mark.parametrize("content", [b"abc", b"abcdefg"])
def test_a_file_that_is_cut_off_raises(spark, tmp_path, content):
    (tmp_path / "odd.txt").write_bytes(content)
    with pytest.raises(Exception, match="is cut off in block"):
        separators.count_tokens(spark, str(tmp_path), 2).collect()


def test_a_file_may_end_within_a_document(spark):
    end = separators.END
    blocks = [(0, [5, end, 6]), (1, [7, 7]), (2, [end, end]), (3, [8])]
    rows = [("f", n, np.array(ids, ">u2").tobytes()) for n, ids in blocks]
    found = separators.stitched(separators.scan(spark.createDataFrame(rows, "file string, block long, ids binary")))
    assert sorted(map(tuple, found.collect())) == [("f", 0, 1, True), ("f", 1, 3, True), ("f", 2, 0, True), ("f", 3, 1, False)]


@pytest.mark.parametrize("name", ["op2_decontamination", "op3_substring_dedup", "op10_url_filters"])
def test_query_matches_sql(spark, sf_dir, name):
    from huntlake.llm.queries import ORACLES, QUERIES

    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    result = connection.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    expected = sorted(map(tuple, result.fetchall()), key=str)
    got = sorted(map(tuple, QUERIES[name](spark, sf_dir).select(names).collect()), key=str)
    assert got == expected and got


def test_items_of_few_words_are_searched_as_a_whole(spark):
    items = [(1, "Alpha"), (2, "two words"), (3, "a b  c"), (4, "d e f g"), (5, "one two three four five"), (6, " "), (7, "two words")]
    rows = [
        (1, "so alpha it is"),
        (2, "alphabet two  WORDS"),
        (3, "a b x c d e f"),
        (4, "z A B C d e f g"),
        (5, "one two three four five"),
        (6, "words two"),
        (7, None),
        (8, ""),
    ]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["containment"]) for r in decontaminate.contamination(documents(spark, rows), df).collect()}
    assert got == {(1, 1, 1, 1.0), (2, 2, 1, 1.0), (2, 7, 1, 1.0), (4, 3, 1, 1.0), (4, 4, 1, 1.0), (5, 5, 1, 1.0)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(documents(spark, rows), df).collect()) == [3, 6, 7, 8]


@pytest.mark.parametrize("rows", [[], [(1, "a b"), (1, "a b"), (1, "c"), (2, None), (3, ""), (None, "x y z")]])
def test_the_token_query_counts_every_row(spark, tmp_path, rows):
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op8_token_counts(spark, str(tmp_path)).collect()
    expected = [(doc_id, len(tokens.ids_of(text)) // 4) for doc_id, text in rows]
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=str) == sorted(expected, key=str)


def test_the_token_query_stands_other_splits_later(spark, sf_dir, settings):
    settings(spark__sql__files__maxPartitionBytes="16k")
    query = queries.op8_token_counts(spark, sf_dir)
    settings(spark__sql__files__maxPartitionBytes="128m")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in query.collect()}
    assert got == {doc_id: len(tokens.ids_of(text)) // 4 for doc_id, text in texts.items()}
