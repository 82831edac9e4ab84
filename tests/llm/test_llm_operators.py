"""Brute-force versions, round trips, held-out accuracy and edge cases."""

import collections
import html
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from topicscope.llm import (
    chat,
    decontaminate,
    html_extract,
    langid,
    licenses,
    near_dedup,
    packing,
    quality_gam,
    quality_rules,
    token_counts,
    tokens,
)
from topicscope.llm.queries import QUERIES

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 7919}" for i in range(60_000))
#: doc_id, text, lang, and a column whose name clashes with outputs
EDGE = [(1, None, "en", 5), (2, "", "en", 5), (3, "  \n\t ", None, 5), (4, "one", "en", 5),
        (5, LONG, "en", 5), (6, "the cat sat on the mat", "en", 5), (6, "the cat sat on the mat", "en", 5),
        (7, "the cat sat on the mat", None, None), (None, "the dog ran off", "en", 5), (8, "12 34 !!", "fr", 5)]
SCHEMA = "doc_id long, text string, lang string, score long"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width \
        else {tuple(w)} if w else set()


def brute_components(docs, width, threshold=80):
    sets = {k: shingles(t, width) for k, t in docs.items()}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small >= threshold * large:
                both = len(sets[a] & sets[b])
                if 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_near_dedup_equals_all_pairs(spark, width):
    rng = random.Random(width)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((12, 40, 150)))] for _ in range(25)]
    docs = {}
    for k in range(400):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 1 + len(words) // 12)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs[k] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           near_dedup.near_duplicates(df, width=width).collect()}
    assert got == brute_components(docs, width)


def test_missed_links_are_found(spark):
    # u and v are alike, and both too far from the centre they share a bucket with
    base = [f"b{i}" for i in range(100)]
    u = base[:70] + [f"x{i}" for i in range(30)]
    rows = [(0, base), (1, u), (2, u[:-2] + ["y0", "y1"]), (3, base[:95] + [f"z{i}" for i in range(5)])]
    sets = spark.createDataFrame([(k, sorted(zlib.crc32(w.encode()) for w in s)) for k, s in rows],
                                 "node long, shingles array<long>")
    star = spark.createDataFrame([(0, 1, False, 1), (0, 2, False, 2), (0, 3, True, 0)],
                                 "a long, b long, linked boolean, component long")
    pairs = {tuple(r) for r in near_dedup._missed_by_stars(star, sets, 80).collect()}
    assert (1, 2) in pairs and (1, 3) not in pairs


def test_near_dedup_edges(edge, empty):
    rows = near_dedup.near_duplicates(edge, width=2).collect()
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows)
    assert got[1, 0, 1, True] == got[2, 0, 2, True] == got[3, 0, 3, True] == 1
    assert got[6, 5, 6, True] == 2 and got[7, 5, 6, False] == 1
    assert got[None, 3, None, False] == 1 and sum(got.values()) == len(EDGE)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_of_rows_without_an_id(spark):
    # many classes under one id (null): each text is read once, for its own class
    rng = random.Random(4)
    words = [[rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(60)] for _ in range(80)]
    texts = [" ".join([*w[:-1], f"x{i}"]) for w in words for i in range(4)]
    df = spark.createDataFrame([(None, t) for t in texts] + [(7, texts[0])], "doc_id long, text string")
    rows = near_dedup.near_duplicates(df).collect()
    got = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in rows)
    assert got == {(None, 7, False): 4, (7, 7, True): 1, (None, None, False): len(texts) - 4}
    left = near_dedup.one_of_each(df, near_dedup.fates(df)).collect()
    assert len(left) == 80 and [r["text"] for r in left if r["doc_id"] == 7] == [texts[0]]


@pytest.mark.parametrize("family", [near_dedup.FAMILY, 4, 10_000])
def test_members_of_one_component_are_not_paired(spark, monkeypatch, family):
    """Two families that differ from the centre in the same words, each one component."""
    monkeypatch.setattr(near_dedup, "FAMILY", family)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    rows, star = [(0, base)], []
    for family in range(2):
        own = base[:80] + [f"f{family}w{i}" for i in range(20)] + [f"common{i}" for i in range(20)]
        for _ in range(150):
            n = len(rows)
            words = list(own)
            words[rng.randrange(120)] = f"n{n}"
            rows.append((n, words))
            star.append((0, n, False, 1 + 150 * family))
    sets = spark.createDataFrame([(k, sorted(zlib.crc32(w.encode()) for w in s)) for k, s in rows],
                                 "node long, shingles array<long>")
    pairs = near_dedup._missed_by_stars(spark.createDataFrame(
        star, "a long, b long, linked boolean, component long"), sets, 80)
    of = {n: c for _, n, _, c in star}
    want = {(x, y) for x, y in itertools.combinations(sorted(of), 2) if of[x] != of[y]
            and 100 * len(set(rows[x][1]) & set(rows[y][1])) >= 80 * len(set(rows[x][1]) | set(rows[y][1]))}
    got = {tuple(r) for r in pairs.collect()}
    assert want <= got and all(of[x] != of[y] for x, y in got)


def check_pieces(rows, texts, window=4096):
    """Exact round trip: every id in one piece, windows gapless, hashes equal."""
    tok = Tokenizer.from_file(WORD_BPE)
    tok.encode_special_tokens = True
    ids = {k: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for k, t in texts.items()}
    of_doc, of_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        a = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(a)
        assert r["ids_crc32"] == zlib.crc32(a[r["start"]:r["start"] + r["length"]].tobytes())
        of_doc[r["doc_id"]].append((r["start"], r["length"]))
        of_window[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(of_doc) == set(ids)
    for parts, total in [(v, len(ids[k])) for k, v in of_doc.items()] + [(v, None) for v in of_window.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at and n > 0
            at += n
        assert at == total if total is not None else at <= window
    return sum(map(len, ids.values())) / (window * len(of_window))


def test_packing_round_trip(spark):
    rows = QUERIES["op2_packing"](spark, SF_CHECK).collect()
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    assert check_pieces(rows, dict(map(tuple, docs))) > 0.99


@pytest.mark.parametrize("kept", [600_000, 40, 0])
def test_block_encoder_equals_tokenizer(monkeypatch, kept):
    """Every text has the whole tokenizer's ids, whatever is kept between blocks."""
    monkeypatch.setattr(tokens, "KEPT_PIECES", kept)
    tok = Tokenizer.from_file(WORD_BPE)
    tok.encode_special_tokens = True
    rng = random.Random(7)
    letters = "aabcdeest .,\n\t'012²½éÉßµªñ¿\u00a0\u00ad\u0085\x00\x7f\u0301日ж’İ"
    texts = [None, "", " \n ", "Don't I'LL 's 'll'd''t", "<|endoftext|> </w> Ā", "x" * 5000,
             *("".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(600)),
             *(" ".join(rng.choices(["the", "Größe,", "naïve.", "a1b2", "ÀÉÎ!"], k=40)) for _ in range(50))]
    encoder = tokens.BlockEncoder(WORD_BPE)
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        ids, bounds = encoder.encode(pa.array(part, pa.string()), 2)
        want = [c.ids + [2] for c in tok.encode_batch([t or "" for t in part], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    ids, bounds = encoder.encode(pa.array([], pa.string()), 2)
    assert not len(ids) and bounds.tolist() == [0]


def test_packing_edges(spark, empty):
    texts = {1: None, 2: "", 3: " ", 4: LONG, 5: "ΣΑΣ İ é́ 中文 x\x1cy\xa0z I'm <|endoftext|>"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = packing.pack(df, WORD_BPE, with_ids=True).collect()
    check_pieces(out, texts)
    assert all(len(r["ids"]) == r["length"] for r in out)
    assert packing.pack(empty, WORD_BPE).count() == 0
    narrow = packing.pack(df.withColumn("doc_id", F.col("doc_id").cast("int")), WORD_BPE)
    check_pieces(narrow.collect(), texts)
    assert narrow.schema["doc_id"].dataType.simpleString() == "int"


def test_packing_deals_by_content(spark):
    """Copies lie in one shard however many there are; one large group is split."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(60))
             for _ in range(200)]
    docs = spark.createDataFrame([(2 * i + j, t) for i, t in enumerate(texts) for j in (0, 1)],
                                 "doc_id long, text string")
    rows = packing.pack(docs, WORD_BPE, window=512, shard_tokens=4096).collect()
    shards = collections.defaultdict(set)
    for r in rows:
        shards[r["doc_id"] // 2].add(r["sequence_id"] >> 32)
    assert len(set().union(*shards.values())) > 10
    assert all(len(v) == 1 for v in shards.values())
    first, several, n = packing.deal(np.array([0, 3, 25, 4, 8, 0, 2]), 10)
    assert (first[[1, 2, 3, 4, 6]].tolist(), several.tolist(), n) == ([0, 1, 4, 5, 5], [1, 1, 3, 1, 1, 1, 1], 6)


def test_bm25_prefers_alike():
    docs = [np.array(x, "<u2") for x in ([5, 6, 7, 8], [1, 2, 3, 4], [5, 6, 7, 9], [1, 2, 9, 9])]
    got = packing.Index(docs, np.ones(1 << 16), 4.0).scores(0)
    assert got[2] > max(got[1], got[3])


def test_language_held_out(spark):
    rows = QUERIES["op3_language_id"](spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    share = rows.where("held_out").join(docs, "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98


def test_language_edges(edge, empty):
    protos = langid.prototypes(edge)
    out = {r["doc_id"]: r for r in langid.predict(edge, protos).collect()}
    for k in (1, 2, 3, 8):
        assert (out[k]["lang_pred"], out[k]["score"]) == ("und", 0.0)
    assert out[6]["lang_pred"] == "en"
    short = langid.prototypes(edge.where("doc_id != 5"))
    assert langid.predict(edge, short).where("doc_id = 7").first()["score"] > 0.5
    assert langid.predict(empty, langid.prototypes(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(edge, {}).collect()} == {"und"}


def test_binding_is_by_place():
    slots = langid.letter_slots("Ab, c!")
    assert slots.tolist() == [0, ord("a"), ord("b"), 0, ord("c"), 0]
    ab, ba = (langid.bind(langid.ngram_codes(langid.letter_slots(t)), 512)[0] for t in ("ab", "ba"))
    assert abs(int(ab.astype(int) @ ba.astype(int))) < 150


def test_token_counts_against_plain_sums(spark, edge, empty):
    lens = token_counts.lengths(edge, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    plain = sorted(r["length"] for r in lens.collect())
    assert len(plain) == sum(t is not None for _, t, _, _ in EDGE) and plain[0] == 0
    sums = token_counts.suffix_sums(token_counts.histogram(lens), block=4)
    for r in sums.collect():
        length = r["length"]
        assert r["docs_longer"] == sum(x > length for x in plain)
        assert r["truncated_total"] == sum(min(x, length) for x in plain)
        assert r["all_tokens"] == sum(plain)
    limits = spark.createDataFrame([(0,), (3,), (10_000_000,)], "limit long")
    got = {r["limit"]: r["total"] for r in token_counts.truncated_totals(sums, limits).collect()}
    assert got == {k: sum(min(x, k) for x in plain) for k in got}
    assert token_counts.quantile(sums, 0.5).first()["length"] == plain[(len(plain) + 1) // 2 - 1]
    assert token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(
        empty, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))).count() == 0


def test_rules_edges_and_ablations(spark, edge, empty):
    text = "a b c d e x a b c d e y a b c d e"
    more = edge.unionByName(spark.createDataFrame([(9, text, "en", 1), (10, "x\nx\n \nx", "en", 1)], SCHEMA))
    out = {r["doc_id"]: r for r in quality_rules.ledger(more).collect()}
    assert out[1]["n_words"] == out[2]["n_words"] == out[3]["n_words"] == 0
    assert out[9]["n_repeat_words"] == 15 and out[10]["n_dup_lines"] == 2 and out[10]["n_lines"] == 3
    assert out[5]["n_words"] == 60_000 and out[5]["n_repeat_words"] == 60_000
    led = quality_rules.ledger(more).collect()
    for r in quality_rules.ablations(quality_rules.ledger(more), "v2").collect():
        bit = quality_rules.mask([r["rule"]])
        assert r["failed"] == sum(bool(x["failures"] & bit) for x in led)
        assert r["kept_without"] == sum(not x["failures"] & ~bit for x in led)
    assert quality_rules.ledger(empty).count() == 0


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "<\\s>", "a\nb", "", None, "\\n\\\\", "<<s>>"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb\\n", None]), rng.choice(nasty))
            for c in range(60) for t in range(rng.randrange(1, 9))]
    ex = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = ex.select("conv_id", "example", chat.parse_turns(F.col("text")).alias("turns"),
                     chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    got = collections.defaultdict(list)
    for r in read.orderBy("conv_id", "example").collect():
        got[r["conv_id"]].append(([tuple(t) for t in r["turns"]], r["loss"]))
    for c in range(60):
        turns = [(role or "", text or "") for k, _, role, text in rows if k == c]
        cuts = [i for i, (role, _) in enumerate(turns) if role == "assistant" or i == len(turns) - 1]
        assert got[c] == [(turns[:i + 1], turns[i][1] if turns[i][0] == "assistant" else "") for i in cuts]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href=/>Home</a></header><nav><ul><li>Menu<li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><div id=wrap><div class="post-12 entry">
<h1>Head &amp; line</h1><p>First <b>bold</b>word<br>next<p>Second&nbsp;one.<script>var t="</p>";</script>
<div class="ad">Buy!</div><form><input name=q><button>Go</button></form><p>Third < 4 &lt;b&gt;</p></div>
<aside>Side</aside><section id="comments"><p>Great post, really a very long comment to outweigh it all, and
more and more of it and more</p></section></div><footer>&copy; us</footer></body></html>"""


def test_html_parts(spark, empty):
    want = "Head & line First boldword next Second one. Third < 4 <b>"
    assert html_extract.text_of(html_extract.read_page(PAGE), None) == want
    pages = spark.createDataFrame([(1, "http://u@H.org:80/x", PAGE, 1), (2, None, None, 1), (3, "x", "", 1),
                                   (4, "//h.org", "<p>plain &#233; text", 1), (4, "//h.org", "a<b", 1)],
                                  "page_id long, url string, html string, text long")
    paths = html_extract.winners(html_extract.votes(pages))
    html_extract.BROADCAST_BYTES, limit = -1, html_extract.BROADCAST_BYTES  # the salted join gives the same rows
    try:
        salted = collections.Counter(map(tuple, html_extract.extract(pages, paths).collect()))
    finally:
        html_extract.BROADCAST_BYTES = limit
    assert salted == collections.Counter(map(tuple, html_extract.extract(pages, paths).collect()))
    out = collections.defaultdict(list)
    for r in html_extract.extract(pages, paths).collect():
        out[r["page_id"]].append(r["text"])
    assert out[1] == [want] and out[2] == out[3] == [""]
    assert sorted(out[4]) == ["a<b", "plain é text"]
    assert html_extract.votes(pages.limit(0)).count() == 0


BODY = "a sentence of the body, and more of it, and so on and on. " * 5


def html_text(source):
    return html_extract.text_of(html_extract.read_page(source), None)


def test_html_nested_containers_of_the_article(spark):
    inner = ["<h1>Head</h1><p>lead</p><blockquote>{}</blockquote>", "<h1>Head</h1><p>lead</p><section>{}</section>",
             "<h1>Head</h1><p>lead</p><table><tr><td>{}</td></tr></table>",
             '<header><h1>Head</h1></header><p>lead</p><div class="entry-content">{}</div>']
    outer = ["<article>{}</article>", "<main><article>{}</article></main>", '<div class="post-7">{}</div>',
             '<div class="wrap">{}</div>']
    rows = [(f"http://h{i}-{j}.org/", "<body><nav>Menu</nav>" + o.format(n.format(BODY))
             + '<div class="sidebar">Side</div></body>')
            for i, o in enumerate(outer) for j, n in enumerate(inner[:3 if "wrap" in o else 4])]
    pages = spark.createDataFrame(rows * 3, "url string, html string")
    got = html_extract.extract(pages, html_extract.winners(html_extract.votes(pages))).collect()
    assert len(got) == 45 and {r["text"] for r in got} == {f"Head lead {BODY.strip()}"}
    # the host's path is another part of this page
    page = html_extract.read_page(f"<body><div>Side</div><article>{BODY}</article></body>")
    assert BODY.strip() in html_extract.text_of(page, "html>body>div")


@pytest.mark.parametrize("page, want", [
    ("<form id=aspnetForm><div>Head</div><div>{}</div></form>", "Head {}"),
    ("<form><article>{0}</article><div id=comments><article>{0}{0}</article></div></form>", "{}"),
    ('<article class="post legal">{}</article><div class="legal">Law</div>', "{}"),
    ('<article class="discussion">{}</article>', "{}"), ('<div id="content" class="widget">{}</div>', "{}"),
    ('<article><h1>Head</h1><div class="widget"><p>{}</p></div></article>', "Head {}"),
    ('<div class="content-sidebar-wrap"><main>{}</main><div class="sidebar">Side</div></div>', "{}"),
    ('<article>{0}<p>their <span class="share">share</span></p><div class="share">Tell all</div></article>',
     "{} their share"),
    ("<article>{}<math><mi>x</mi><mo>=</mo><mn>2</mn></math></article>", "{} x=2"),
    ("<article>{0}</article><form><p>{0}</p></form><div class='cookie-consent'>{0}{0}</div>", "{}"),
    ("<div>{0}</div><section id=comments><article>{0}{0}</article><article>{0}</article></section>", "{}"),
    ("<nav>{}</nav><script>no text</script>", "{}"), ("<div hidden>{}</div>", "{}")])
def test_html_wrappers_of_the_article(page, want):
    assert html_text(f"<body>{page.format(BODY)}</body>") == want.format(BODY.strip())


@pytest.mark.parametrize("broken", ["<![CDATA[" * 110_000, "<a b='" * 170_000, "<a b='" * 170_001 + ">",
                                    "<div class=x>" * 40_000 + "text", "<!--" * 100_000, "<" * 300_000])
def test_broken_pages_are_read_in_one_pass(broken):
    began = time.process_time()
    html_extract.text_of(html_extract.read_page(broken), "html>div.x")
    assert time.process_time() - began < 4


def test_inline_adverts_and_long_paths():
    page = "<article class=a1><p>one <span class='ad'>AD</span> two <b id=top-ad-3>X</b><i class=added> three</i></p></article>"
    read = html_extract.read_page(page)
    assert html_extract.text_of(read, None) == "one two three"
    assert html_extract.path_of(read, html_extract.best_container(read)[0]) == "html>article.a0"
    assert html_extract.on_path(read, "html>article.a0") == {1} and not html_extract.on_path(read, "html>div")


def test_html_whole_table(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in QUERIES["op7_html_extraction"](spark, SF_SMALL).collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_licenses_against_plain_containment(spark, edge, empty):
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 400))]
        for _, t in rng.sample(licenses.TEMPLATES, rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = t.split()
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan(df).collect():
        w = decontaminate.words_of(r["text"].encode())
        for name, t in licenses.TEMPLATES:
            tw = decontaminate.words_of(t.encode())
            k = min(5, len(tw))
            grams = {tuple(tw[i:i + k]) for i in range(len(tw) - k + 1)}
            whole = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
            if grams <= whole:
                assert name in {m["license"] for m in r["licenses"]}
        for m in r["licenses"]:
            assert m["containment"] >= 0.8 and r["text"][m["start"]:m["end"]].strip()
    assert all(not r["licenses"] for r in licenses.scan(edge).collect())
    assert licenses.scan(empty).count() == 0


def test_licenses_of_the_whole_table(spark, tmp_path):
    table = licenses.read_templates()
    assert table[:len(licenses.TEMPLATES)] == licenses.TEMPLATES
    path = str(tmp_path / "templates.parquet")
    spark.createDataFrame(table, "license string, text string").write.parquet(path)
    assert sorted(licenses.read_templates(spark, path)) == sorted(table)
    texts = [f"foo bar {t} baz qux" for _, t in table]
    # a second time, with a word of the long texts exchanged
    worn = [" ".join(["gone" if i == 30 and len(t.split()) > 90 else w for i, w in enumerate(t.split())])
            for t in texts]
    df = spark.createDataFrame([(i, f"{t} and then {w}") for i, (t, w) in
                                enumerate(zip(texts, worn, strict=True))], "doc_id long, text string")
    for r in licenses.scan(df).collect():
        name = table[r["doc_id"]][0]
        found = [m for m in r["licenses"] if m["license"] == name]
        assert len(found) == 2 and found[0]["end"] <= found[1]["start"] and found[0]["containment"] == 1
        assert {m["license"].removesuffix("-text").removesuffix("-full") for m in r["licenses"]} \
            == {name.removesuffix("-text").removesuffix("-full")}


def test_every_place_of_a_license(spark):
    mit, text = licenses.TEMPLATES[0][1], licenses.TEMPLATES[7][1]
    for t, name in ((mit, "MIT"), (text, "MIT-text")):
        for between in (" ", " x y z "):
            whole = "Ä " + between.join([t] * 3)
            rows = licenses.scan(spark.createDataFrame([(whole,)], "text string")).first()["licenses"]
            assert [m["license"] for m in rows] == [name] * 3
            # up to the last word: a sign at the end is no word
            assert [whole[m["start"]:m["end"]] for m in rows] == [t.rstrip(".")] * 3


def test_quality_held_out(spark):
    rows = QUERIES["op9_quality_classifier"](spark, SF_CHECK).where("held_out")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    share = rows.join(labels, "doc_id").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert share > 0.9


def test_quality_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_gam.fit(edge, none)
    assert {r["score"] for r in quality_gam.score(edge, model).collect()} == {0.5}
    assert quality_gam.score(empty, model).count() == 0


def test_gam_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit_rows(x, y)
    assert (model.score(x).round() == y).mean() > 0.95
    assert {tuple(sorted((a, b))) for a, b, _ in model.pairs} >= {(0, 1)}


def test_decontamination_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, "The cat"), (1, "The cat"), (2, "sat on the MAT"), (3, None), (None, "cat"),
                                   (10, "the cat"), (4, " .. ")], "item_id long, text string")
    for block in (1 << 20, 40):  # one block, and several in a chain
        out = {r["doc_id"]: r for r in decontaminate.scan(edge, bench, block_bytes=block).collect()}
        assert out[6]["n_hit"] == 6 and out[6]["items"] == ["1", "10", "2"]
        (hit,) = out[6]["hits"]
        assert (hit["start"], hit["end"]) == (0, 22)
        assert out[1]["n_words"] == out[2]["n_words"] == 0 and out[4]["n_hit"] == 0
    assert decontaminate.scan(empty, bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.scan(edge, bench.limit(0)).collect()} == {0}


def test_pipeline_against_its_rules(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "packing":
            assert docs.columns == columns
        left[name] = docs
    kept = {r["doc_id"]: r["text"] for r in left["quality_rules"].collect()}
    parts = brute_components(kept, 5)
    assert {r["doc_id"] for r in left["near_dedup"].collect()} == {c for _, c in parts.values()}
    check_pieces(left["packing"].collect(), {r["doc_id"]: r["text"] for r in left["decontamination"].collect()})
    assert corpus_pipeline.run(spark, SF_SMALL).count() == left["packing"].count()


def test_pipeline_dedup_loses_no_text(spark):
    a, b, c = ("the first text is about one thing", "a second text that says something else",
               "words that several rows hold again and again")
    rows = [(1, a, "x"), (1, b, "x"), (None, c, "x"), (None, c, "y"), (5, c, "z"), (5, c, "a"), (None, a + " indeed", "x"),
            (None, None, "x"), (2, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = sorted(tuple(r) for r in corpus_pipeline.dedup(spark, docs, SF_SMALL).fillna(-1).fillna("").collect())
    assert left == sorted([(1, a, "x"), (1, b, "x"), (5, c, "a"), (-1, a + " indeed", "x"), (-1, "", "x"), (2, "", "x")])


def test_pipeline_edges(spark, empty):
    table = spark.createDataFrame(
        [(*r, "s", 1) for r in EDGE], "doc_id long, text string, lang string, failures long, source string, n_chars long")
    for docs in (table, table.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            docs = spark.createDataFrame(out.collect(), out.schema)
