import html
import random
import re
import time
import zlib
from itertools import product

import brute
from cases import FOLDER, HARD, documents, duck, hard, nothing, rows_of, same  # noqa: F401
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import html_extraction, packing, resharding, substring_dedup, url_filters, workload
from tidemark.llm.workload import ORACLES, tokenizer_path

OP1 = ("page_id", "host", "path", "rule", "verdict")


def test_urls_of_the_whole_table(spark, duck):
    same(rows_of(workload.op1_url_filter(spark, FOLDER), *OP1), duck.execute(ORACLES["op1_url_filter"]).fetchall())


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "a://b.example.com/en", "x://net/es/", "x://a.net/es/1",
        "x://anet/es/", "y://www.example.com/en/", "y://www.example.com", "u://com//", "u://com/?a://b/c", "x://.com/", "x://a.com:80/", "p://É.com/é/", "x://" + "a." * 3000 + "com/" + "p/" * 3000]


def expected(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate(brute.UPPER)
    best = None
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return (host, path, best[1] if best else None, best[0] if best else "allow")


@pytest.mark.parametrize("bits", [None, 0.7])
def test_urls_by_cascades_with_few_bits(spark, bits):
    rng = random.Random(7)
    rules = [*workload.URL_RULES, *((rng.choice(["allow", "block"]), f"h{i}.org/{'d/' * rng.randrange(3)}") for i in range(40))]
    urls = URLS + [f"http://{rng.choice(['', 'x.'])}h{rng.randrange(80)}.org/{'d/' * rng.randrange(4)}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame(rules, "verdict string, rule string")
    found = url_filters.judged(pages, listed, bits_per_key=bits)
    same(rows_of(found, *OP1), [(i, *expected(u, rules)) for i, u in enumerate(urls)])


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    listed = keys.where("key LIKE '%7'")
    levels = url_filters.cascade(listed, keys, bits_per_key=1.0)
    assert len(levels) > 2
    found = keys.where(url_filters.member(keys["key"], levels))
    assert rows_of(found, "key") == rows_of(listed, "key")


def test_no_urls_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([("block", "com/")], "verdict string, rule string")
    assert url_filters.judged(pages, rules).collect() == []
    one = spark.createDataFrame([(1, "x://a.com/")], "page_id long, url string")
    assert rows_of(url_filters.judged(one, rules.limit(0)), *OP1) == [(1, "a.com", "/", None, "allow")]


def check_shards(placed, rows, shards):
    table = placed.toPandas()
    plain = lambda t: (t or "").encode()
    wanted = sorted((repr(d), len(plain(t)) + 16, zlib.crc32(plain(t))) for d, t in rows)
    ids = [None if x != x else int(x) for x in table["doc_id"].astype(object).where(table["doc_id"].notna(), float("nan"))]
    assert sorted(zip(map(repr, ids), table["size"], table["text_crc32"], strict=True)) == wanted
    for _, own in table.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    sizes = table.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    return sizes


def test_shards_of_the_whole_table(spark, documents):
    sizes = check_shards(workload.op7_resharding(spark, FOLDER), documents, 40)
    assert sizes.max() - sizes.min() <= max(len(t.encode()) for _, t in documents) + 16


@pytest.mark.parametrize("block_rows", [3, 50_000])
def test_shards_of_hard_rows(hard, nothing, block_rows):
    check_shards(resharding.resharded(hard, block_rows=block_rows), HARD, 40)
    assert resharding.resharded(nothing).collect() == []


def test_small_rows_fill_shards_evenly(spark):
    rows = [(i, "x" * (i % 90)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = resharding.resharded(docs, block_rows=20)
    sizes = check_shards(placed, rows, 40)
    assert sizes.max() - sizes.min() < 0.04 * sizes.mean()
    moved = resharding.moves(placed).toPandas()["bytes"].sum()
    old = placed.groupBy("old_shard").agg({"size": "sum"}).toPandas()["sum(size)"]
    least = old.sum() - sum(min(x, old.sum() / 40) for x in old)
    assert moved <= least + 0.02 * old.sum()


def test_affected_shards_are_rewritten(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i % 9}") for i in range(200)] + [(1, "text 1")], "doc_id long, text string")
    placed = resharding.resharded(docs)
    resharding.rewrite(docs, placed, str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out"))
    moved = placed.where("old_shard <> shard").collect()
    affected = {r["shard"] for r in moved} | {r["old_shard"] for r in moved}
    wanted = sorted((r["doc_id"], r["shard"], r["slot"]) for r in placed.collect() if r["shard"] in affected)
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in found.collect()) == wanted


def test_flow_is_the_cheapest():
    rng = random.Random(8)
    for _ in range(30):
        supply = [rng.randrange(4) for _ in range(3)]
        room = resharding.capacities(sum(supply) + rng.randrange(2), 3)
        cost = [[rng.randrange(4) for _ in range(3)] for _ in range(3)]
        flow = resharding.min_cost_flow(supply, room, lambda i, j: cost[i][j])
        assert flow.sum(axis=1).tolist() == supply and (flow.sum(axis=0) <= room).all() and (flow >= 0).all()
        units = [i for i, n in enumerate(supply) for _ in range(n)]
        best = min(
            (sum(cost[i][j] for i, j in zip(units, to, strict=True)) for to in product(range(3), repeat=len(units)) if all(to.count(j) <= room[j] for j in range(3))),
            default=0,
        )
        assert sum(flow[i, j] * cost[i][j] for i in range(3) for j in range(3)) == best
    with pytest.raises(ValueError):
        resharding.min_cost_flow([5], [4], lambda i, j: 0)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def check_pieces(pieces, ids, length=4096):
    """``ids`` lists the ids of every document; documents of one id may swap."""
    table = pieces.toPandas()
    total = sum(len(i) for own in ids.values() for i in own)
    assert table["length"].sum() == total and (table["length"] > 0).all()
    filled = table.groupby("sequence_id")["length"].sum()
    assert filled.index.tolist() == list(range(-(-total // length))) and (filled.iloc[:-1] == length).all()
    for _, own in table.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]]
    for row in table.itertuples():
        doc = None if row.doc_id != row.doc_id else row.doc_id
        assert any(
            len(i) == row.doc_tokens and brute.crc(i[row.start : row.start + row.length]) == row.ids_crc32 for i in ids[doc]
        )


def ids_of(tokenizer, rows):
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])
    return ids


def test_packing_of_the_whole_table(spark, documents, tokenizer):
    check_pieces(workload.op9_packing(spark, FOLDER), ids_of(tokenizer, documents))


def test_packing_of_hard_rows(hard, nothing, tokenizer):
    check_pieces(packing.pack(hard, tokenizer_path("word_bpe_49k.json")), ids_of(tokenizer, HARD))
    assert packing.pack(nothing, tokenizer_path("word_bpe_49k.json")).collect() == []


def test_words_have_the_ids_of_the_tokenizer(tokenizer):
    table = packing.Tokens(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(9)
    letters = "abcXYZ019 .,!'#<|>é ÉßİıſŒæñ×÷\u00a0\u0301\u1e9eΣς漢😀\x85\x1c\t\n"
    texts = ["", "don't I'LL <|endoftext|> x<|startoftext|>y", "İstanbul ſ ﬁ A\u0301 ΑΣ ", "a\u00a0b\u2028c", *("".join(rng.choices(letters, k=40)) for _ in range(400))]
    for text in texts:
        assert table.of(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    ids, ends = table.of(pa.array([None, *texts, ""]))
    assert [i.tolist() for i in np.split(ids, ends)[1:-2]] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_sequences_hold_the_packed_ids(spark, tokenizer):
    rows = [(i, f"some words {i} " * (i * 7)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = packing.sequences(docs, tokenizer_path("word_bpe_49k.json"), length=64, pad=0).collect()
    assert all(len(r["ids"]) == 64 for r in found)
    joined = [t for r in sorted(found, key=lambda r: r["sequence_id"]) for t in r["ids"]]
    left = [own[0] for own in ids_of(tokenizer, rows).values()]
    total = sum(map(len, left))
    assert not any(joined[total:])
    while left:  # the documents one after another, in some order
        first = next(own for own in left if joined[: len(own)] == own)
        joined = joined[len(first) :]
        left.remove(first)


def article(page):
    inside = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
    return "\n\n".join(x for x in parts if x)


def test_text_of_all_pages(spark):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    wanted = [(p["page_id"], p["url"], article(p["html"]), len(article(p["html"]))) for p in pages]
    same(rows_of(workload.op10_html_extraction(spark, folder), "page_id", "url", "text", "n_chars"), wanted)


PAGE = """<html><head><title>t</title><script>if (a < b) "<p>x</p>"</script></head><body>
<header><a href="/">Home page of the site</a><p>Welcome to our site, dear reader.</p></header>
<div class="cookie-notice">We use cookies &amp; more. Please agree to all of them now.</div>
<ul id="menu"><li><a href="/a">One</a><li><a href="/b">Two</a></ul>
<main><article><header><h1>A&nbsp;title</h1></header><p>First   paragraph &lt;here&gt; with a <b>bold</b> word.
<p>No.<p>Last paragraph, which is a little longer than the one before.<ul><li>Point one.<li>Point two.</ul></article></main>
<aside><p>Related: a long sentence about something else that nobody asked for.</p></aside>
<section class="comments"><h3>Comments</h3><p>I really like this article. It is very good and long.</p></section>
<form><p>Leave your mail address here.</p><input name=x></form><footer><p>All rights reserved by us.</p></footer></body>"""


def test_boilerplate_goes_and_short_paragraphs_stay():
    assert html_extraction.main_text(PAGE).split("\n\n") == [
        "A title",
        "First paragraph <here> with a bold word.",
        "No.",
        "Last paragraph, which is a little longer than the one before.",
        "Point one.",
        "Point two.",
    ]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<p>", "a<b", "<!--", "<script>", "</p></p>", "<p class=>", "&#xD800;&bogus;", "<a " * 3000, "<div>" * 5000 + "deep"])
def test_odd_pages(page):
    assert isinstance(html_extraction.main_text(page), str)


def test_pages_with_nulls(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (3, "v", PAGE)]
    found = html_extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert rows_of(found.where("n_chars = 0"), "page_id", "url", "text") == [(1, None, ""), (1, None, ""), (None, "u", "")]
    assert found.count() == 4


def test_cut_is_the_least():
    rng = random.Random(10)
    for _ in range(60):
        n = rng.randrange(1, 7)
        scores = [rng.randrange(-40, 41) / 10 for _ in range(n)]
        ties = [(a, b, rng.randrange(0, 30) / 10) for a in range(n) for b in range(a) if rng.random() < 0.6]

        def cost(labels, scores=scores, ties=ties):
            return sum(abs(s) for s, keep in zip(scores, labels, strict=True) if (s > 0) != keep and s) + sum(t for a, b, t in ties if labels[a] != labels[b])

        best = min(cost(labels) for labels in product([False, True], repeat=n))
        assert abs(cost(html_extraction.minimum_cut(scores, ties)) - best) < 1e-9


#: Names of columns that stages or operators use themselves.
CLASHING = (
    "own_hash _own_hash cuts found_language marks spans text_hash lang_pred score component_id n_shingles region units "
    "hashes n node __hash __found __ranges __language"
).split()


def test_stages_keep_the_columns_and_clean_documents(spark, documents, tokenizer):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASHING})
    columns, kept = docs.columns, dict(documents)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.settled(stage(spark, docs, FOLDER), name)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and all(len(r["text"]) == r["n_chars"] for r in docs.collect())
        assert all(r[c] == f"{c}{r['doc_id']}" for r in docs.collect() for c in CLASHING)
        if name == "language":
            wanted = before
        elif name == "near_duplicates":
            wanted = {d: before[d] for d, n, c in brute.op4(before.items()) if d == c or not n}
        elif name == "repeats":
            gone = {d for d, _, n, _ in brute.op3(before.items()) if n}
            wanted = {d: after[d] if d in gone else t for d, t in before.items()}
            cut = {d: sha for d, _, _, sha in brute.op3(before.items())}
            assert all(brute.op3([(d, after[d])])[0][3] == cut[d] for d in gone)
        else:
            hits = {d for d, _, n, *_ in brute.op6(before.items(), [(i["item_id"], i["text"]) for i in items]) if n}
            wanted = {d: after[d] if d in hits else t for d, t in before.items()}
            assert hits and not any(r[2] for r in brute.op6(after.items(), [(i["item_id"], i["text"]) for i in items]))
        assert after == wanted
    check_pieces(corpus_pipeline.pack(spark, docs, FOLDER), ids_of(tokenizer, after.items()))
    assert kept.keys() >= after.keys()


def test_stages_take_hard_and_empty_tables(spark, hard, nothing):
    for start in (hard, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.settled(stage(spark, docs, FOLDER), name)
            assert name == "pack" or docs.columns == start.columns
    ids = [r["doc_id"] for r in substring_dedup.removal_digest(hard).collect()]
    assert len(ids) == len(HARD)


BODY = "<p>One long sentence that stands in the page for all to read, here and now.</p><p>And another one that follows it.</p>"
SHOWN = "One long sentence that stands in the page for all to read, here and now.\n\nAnd another one that follows it."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title><body>{BODY}</body></html>",
        f"<html><head><meta charset=utf-8><title>x</title><style>p {{}}</style>{BODY}</html>",
        f"<head><title>x</title><template><div>hidden</div></template><noscript><p>hidden</p></noscript><main>{BODY}</main>",
        f"<html><head><title>x<body>{BODY}<svg><title>icon</title></svg></body></html>",
        *[f"<body><div><{tag}>hidden {BODY}</div></body>" for tag in "select button object canvas noscript template iframe svg video textarea".split()],
        f"<body><div><noscript>hidden {BODY}<noscript><p>hidden</p></noscript></div></body>",
        f"<body><select><option>hidden<option>hidden <button>hidden {BODY}<button>hidden</button></body>",
        *[f"<body>{BODY}<{tag}><div>hidden</div><p>hidden</p></{tag}></body>" for tag in "button object canvas noscript template".split()],
        f"<body>{BODY}<template><button>hidden<div>hidden</div></template></body>",
    ],
)
def test_missing_end_tags_silence_nothing_else(page):
    assert html_extraction.main_text(page) == SHOWN


def test_text_ends_a_head():
    text = "Text that stands in no element of its own, but is long enough to be read."
    assert [b.text for b in html_extraction.blocks(f"<html><head><title>x</title>\n{text}<div></div></html>")] == [text]


LONG = "Words of a long paragraph that goes on and on for a while, and ends here. " * 4


@pytest.mark.parametrize("names", ["content no-sidebar", "has-comments", "legal", "post-text tags"])
@pytest.mark.parametrize("tag", ["div", "article"])
def test_names_of_a_wrapper_do_not_cost_the_article(tag, names):
    page = f"<body><nav><a href=x>Home</a></nav><{tag} class='{names}'>{f'<p>{LONG}</p>' * 3}</{tag}><footer>us</footer></body>"
    assert html_extraction.main_text(page) == "\n\n".join([LONG.strip()] * 3)


def test_names_that_tell_what_text_is_about():
    page = f'<article><p>{LONG}</p><p class="notice-of-meeting">The meeting is on Monday.</p><p>{LONG}</p></article>'
    assert "The meeting" in html_extraction.main_text(page)


@pytest.mark.parametrize("names", ["comments", "reader-comments", "replies"])
def test_many_reader_comments_are_no_article(names):
    page = f"<body><article><p>{LONG}</p></article><div class='{names}'>{f'<p>{LONG}</p>' * 30}</div></body>"
    assert html_extraction.main_text(page) == LONG.strip()


def test_quote_signs_in_values():
    page = f"<article><p title=5\">{LONG}</p><p data-x=it's>First of them.</p><p title='a > b'>Second of them.</p></article>"
    assert html_extraction.main_text(page).split("\n\n") == [LONG.strip(), "First of them.", "Second of them."]


@pytest.mark.parametrize(
    "piece", ["<a ", "<div>a", '<p x="', "<b><u>x</i>", "<button>x<i>", "<svg><g>", "<b><hr>", "<p x='>it\" ", "<!", "<p>a<b>"]
)
def test_time_grows_with_the_page(piece):
    """Four times the text may not take ten times as long; a quadratic reader takes sixteen."""

    def seconds(size):
        page = piece * (size // len(piece))
        start = time.process_time()
        html_extraction.main_text(page)
        return time.process_time() - start

    assert seconds(400_000) < 10 * max(seconds(100_000), 0.05)


def test_no_pages(spark):
    assert html_extraction.extracted(spark.createDataFrame([], "page_id long, url string, html string, text int")).collect() == []
