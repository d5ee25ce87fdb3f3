"""Quality rules, language, chat formatting, HTML, LM scoring: against plain versions and by round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartoledger.llm import chat, htmltext, langid, lm, quality, trie
from cartoledger.llm.common import ngram_hashes
from tests.llm import helpers

SF = "/root/testdata/sf0.001"


def test_rolling_hash_equals_horner():
    values = np.arange(1, 40, dtype=np.uint64) * np.uint64(7919)
    for n in range(1, 15):
        want = []
        for i in range(len(values) - n + 1):
            h = 0
            for v in values[i : i + n].tolist():
                h = (h * 0x9E3779B97F4A7C15 + v) % 2**64
            want.append(h)
        assert ngram_hashes(values, n).tolist() == want
    assert len(ngram_hashes(values[:3], 4)) == 0


def test_quality_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.Rules()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = {r[0]: tuple(r)[1:8] for r in quality.quality(docs, rules).collect()}
    assert got == {i: helpers.quality(t, rules.max_shares) for i, t in texts.items()}
    kept = {r["doc_id"] for r in quality.keep_good(docs, rules).collect()}
    assert kept == {i for i, g in got.items() if g[6]}
    assert 0 < len(kept) < len(texts)


def test_quality_awkward_rows(spark):
    docs = helpers.awkward(spark)
    rows = quality.quality(docs).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[6]["word_chars"] == 1 and by[7]["n_words"] == 4
    assert by[5]["kept"] and by[5]["n_words"] == 60_000
    assert quality.keep_good(docs).schema == docs.schema
    assert quality.quality(docs.limit(0)).count() == quality.keep_good(docs.limit(0)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    learn = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    raw = langid.dictionaries(docs.where(docs["doc_id"].isin(list(learn))))
    assert set(raw) == {"de", "en", "es", "fr"}
    got = {r["doc_id"]: r for r in langid.identify(docs, raw).collect()}
    test = [r for r in rows if r["doc_id"] not in learn]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in test) / len(test) > 0.97
    sure = [r for r in test if got[r["doc_id"]]["accepted"]]
    assert len(sure) / len(test) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_awkward_rows(spark):
    docs = helpers.awkward(spark, [(8, "12345 !? 67"), (9, "THE AND OF THE WITH")])
    raw = {"de": b"der die und das ist nicht mit ein eine auf", "en": b"the and of that with this from are was for"}
    got = {r["doc_id"]: r for r in langid.identify(docs, raw).collect()}
    for i in (1, 2, 3, 8):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
    assert got[9]["lang_pred"] == "en"
    assert langid.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(docs.limit(0), raw).count() == 0
    assert langid.dictionaries(docs.limit(0)) == {}
    assert set(langid.dictionaries(docs)) == {"en"}


def test_language_sample_is_bounded(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["text"].lower().encode() for r in docs.where("text is not null").collect()}
    longest = max(len(t) for t in texts)
    raw = langid.dictionaries(docs, rows=40, budget=5000)
    assert all(len(v) <= 5000 + longest + 40 for v in raw.values())
    assert all(len(v) >= 5000 for v in raw.values())
    few = langid.dictionaries(docs.where("not contains(text, '\n')"), rows=3, budget=10**6)
    assert all(len(v.split(b"\n")) == 3 and set(v.split(b"\n")) <= texts for v in few.values())


def test_language_of_short_texts_is_learned(spark):
    """A language whose labelled texts all have a few words gets a dictionary and is predicted."""
    english = [(i, f"the house and the garden of number {i} were sold to a friend of the family", "en") for i in range(60)]
    short = [(100 + i, t, "xx") for i, t in enumerate(["zuku balo", "balo mibi", "mibi zuku", "zuku zuku balo"])]
    docs = spark.createDataFrame([*english, *short, (200, "1234567", "no")], "doc_id long, text string, lang string")
    raw = langid.dictionaries(docs)
    assert set(raw) == {"en", "xx"} and b"zuku balo" in raw["xx"]
    test = spark.createDataFrame([(1, "balo zuku mibi balo zuku"), (2, "the garden of the family")], "doc_id long, text string")
    assert {r[0]: r[1] for r in langid.identify(test, raw).collect()} == {1: "xx", 2: "en"}


def test_language_numerals_are_no_letters(spark):
    raw = {"de": b"der die und das ist nicht mit ein eine auf", "en": b"the and of that with this from are was for"}
    docs = spark.createDataFrame([(1, "½ ² Ⅷ 12 _"), (2, "ª")], "doc_id long, text string")
    assert {r[0]: r[1] == "und" for r in langid.identify(docs, raw).collect()} == {1: True, 2: False}


@pytest.mark.parametrize("seed", range(4))
def test_language_verdict_equals_plain_version(spark, seed):
    """Sizes, order, score and margin by plain calls of the compressor."""
    import math

    import zstandard

    rng = random.Random(seed)
    raw = {k: " ".join(rng.choices(v, k=80)).encode() for k, v in {"aa": ["ba", "be", "bi"], "bb": ["to", "ta", "bi"], "cc": ["ki"]}.items()}
    texts = [" ".join(rng.choices(["ba", "be", "TO", "ta", "ki", "bi", "x1"], k=rng.randrange(1, 3000))) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.identify(docs, raw, block=512).collect():
        data = texts[r["doc_id"]].lower().encode()
        sizes = {}
        for lang, words in raw.items():
            given = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(6, dict_data=given, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(coder.compress(data[i : i + 512])) for i in range(0, len(data), 512))
        best, second = sorted((n, lang) for lang, n in sizes.items())[:2]
        gap = second[0] - best[0]
        assert r["lang_pred"] == best[1] and r["accepted"] == (gap >= 2 and gap >= 0.005 * best[0])
        assert math.isclose(r["score"], 1 / sum(2.0 ** max(-1000, -8 * (n - best[0])) for n in sizes.values()))


CONTROL = st.lists(st.sampled_from(["<", "|", "\\", "<|", "<\\|", "<|im_end|>", "\n", "a", "é", "<|im_start|>", "\\n"]), max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(CONTROL.map("".join), CONTROL.map("".join)), min_size=1, max_size=6))
def test_chat_round_trip(rows):
    roles = [r.encode() for r, _ in rows]
    texts = pa.array([t.encode() for _, t in rows], pa.binary())
    buffer, offsets, first, last = chat.assemble(roles, texts)
    for i, (role, text) in enumerate(rows):
        segment = buffer[offsets[i] : offsets[i + 1]].tobytes()
        assert chat.read_segment(segment) == (role.encode(), text.encode())
        inner = segment[first[i] : last[i]]
        assert inner == chat.escape(text.encode()) and b"<|" not in inner
        assert chat.unescape(inner) == text.encode()
    # a slice with an offset gives the same bytes
    if len(rows) > 1:
        part, at, _, _ = chat.assemble(roles[1:], texts.slice(1))
        assert part.tobytes() == buffer[offsets[1] :].tobytes()


def test_chat_conversations(spark):
    rows = [(1, 1, "assistant", "é<|im_end|>"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "assistant", "y")]
    rows += [(3, 0, "assistant", "b"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, None, "user", "first"), (4, 0, "user", "z" * 300_000)]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, segment string")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_turns(turns)).collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[1]["turns_sha256"] == sha("user\n\nassistant\né<|im_end|>\n") and got[1]["loss_sha256"] == sha("é<|im_end|>")
    assert got[1]["loss_chars"] == 11 and got[2]["turns_sha256"] == sha("\nx\n") and got[None]["loss_chars"] == 1
    assert got[3]["turns_sha256"] == sha("user\nfirst\nassistant\na\nassistant\na\nassistant\nb\n") and got[3]["n_turns"] == 4
    assert got[4]["formatted_chars"] == 300_000 + len("<|im_start|>user\n<|im_end|>\n")
    assert chat.digest(chat.format_turns(turns.limit(0))).count() == 0


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<div class="site-header">Site</div><nav><a>Menu</a></nav><!-- c --><div class="box">Box of host</div>
<main><article><h1>Head &amp; line</h1><p>One <b>bold
text</b>&nbsp;here<p>Two<br>lines<script>var a="</p>";</script><div class="ad">Buy</div>
<aside>Side</aside><p>Said by all.</p><ul><li>a<li>b</ul><table><tr><td>1<td>2</table>
<section id="comments"><p>Nice</p></section></article></main><div class="cookie-notice">Ok?</div><footer>F</footer></body></html>"""


def test_html_main_text():
    want = "Head & line\n\nOne bold text here\n\nTwo lines\n\nSaid by all.\n\na\n\nb\n\n1\n\n2"
    assert htmltext.extract(PAGE, set()) == want
    for page in ("", "<", "<p", "</p>", "<p><p></b></i>", "<script>x", "<a href='>'>", "&amp", "<!-- x", "<article>" * 3000 + "x"):
        htmltext.extract(page, set())
        htmltext.page_subtrees(page)
    assert htmltext.extract("a &lt; b<p>c", set()) == "a < b\n\nc"


def test_html_templates(spark):
    """Subtrees that recur on a host go, others and prose inside articles stay; counted here by hand."""
    rows = []
    for i in range(12):
        host = "http://a.example/" if i < 8 else "https://b.example/"
        once = "" if i % 2 else f"<div>own {i}</div>"
        rows.append((i, f"{host}{i}", f"<body><div class='x'>Host box</div>{once}<div>Text {i}</div><span>few</span></body>"))
    rows += [(20, None, "<p>x</p>"), (21, "http://[broken", None), (22, "http://a.example/z", ""), (22, "http://a.example/z", "")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in htmltext.main_text(pages, min_pages=5, min_share=0.3).collect()}
    assert got[0] == "own 0\n\nText 0" and got[1] == "Text 1"  # box and span recur on 8 of 9 pages of a.example
    assert got[9] == "Host box\n\nText 9\n\nfew"  # on 4 pages of b.example only
    assert got[20] == "x" and got[21] == "" and got[22] == ""
    far = {r["page_id"]: r["text"] for r in htmltext.main_text(pages, min_pages=5, min_share=0.3, broadcast_rows=0).collect()}
    assert far == got
    assert htmltext.main_text(pages.limit(0)).count() == 0


def test_html_templates_inside_articles(spark):
    """A box on every page of a host goes from the article; sentences, lists and copies of one page stay whole."""
    rows = []
    for i in range(8):
        box = "<div class='x1'>Read our <b>terms</b></div><span>Send</span>"
        rows.append((i, f"http://a.example/{i}", f"<article><p>Text {i} of <a>Acme</a></p>{box}<ul><li>salt<li>{i}</ul></article>"))
        rows.append((10 + i, f"http://b.example/{i}", f"<nav>{i}</nav><article><p>One</p><p>Two</p></article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (200_000, 0):
        got = {r["page_id"]: r["text"] for r in htmltext.main_text(pages, broadcast_rows=limit).collect()}
        assert got == {i: f"Text {i} of Acme\n\nsalt\n\n{i}" for i in range(8)} | {10 + i: "One\n\nTwo" for i in range(8)}


def test_html_class_names_and_articles():
    """Known names count as a whole, what holds the article stays, an article keeps its header, all articles count."""
    body = "<p class='notice-period'>A</p><div class='elementor-widget-text-editor'>B</div><p id='market-share'>C</p>"
    for around in ("wrap no-sidebar", "has-sidebar", "sidebar", "widget"):
        page = f"<div class='{around}'><article><header class='header'><h1>H</h1></header>{body}</article></div><footer>F</footer>"
        assert htmltext.extract(page, set()) == "H\n\nA\n\nB\n\nC"
        assert htmltext.extract(f"<form><main>{page}</main></form>", set()) == "H\n\nA\n\nB\n\nC"
    assert htmltext.extract("<body><div class='wrap no-sidebar'><p>x</p></div></body>", set()) == "x"
    several = "<header>S</header><main><p>Lead</p><article>One</article><article>Two longer</article></main>"
    assert htmltext.extract(several, set()) == "Lead\n\nOne\n\nTwo longer"
    assert htmltext.extract("<article>One</article><p>x</p><article>Two longer</article>", set()) == "One\n\nTwo longer"
    aside = "<main><p>The text of this page</p><div class='related'><article>Other</article></div></main>"
    assert htmltext.extract(aside, set()) == "The text of this page"


def test_html_real_pages_keep_whole_articles(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in htmltext.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", article[1]) if article else "")
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=200), st.lists(st.integers(0, 3100), min_size=1, max_size=50))
def test_elias_fano(values, wanted):
    import tempfile

    values = np.sort(np.array(values, np.int64))
    with tempfile.TemporaryDirectory() as folder:
        coded = trie.EliasFano(folder, "x", values)
        assert coded.get(np.arange(len(values))).tolist() == values.tolist()
        assert coded.successor(np.array(wanted)).tolist() == np.searchsorted(values, wanted).tolist()


def test_quantised_probabilities_are_close():
    p = 10.0 ** -np.linspace(0, 10, 999)
    assert np.abs(np.log10(trie.dequantise(trie.quantise(p))) + np.linspace(0, 10, 999)).max() <= trie.STEP / 2 + 1e-9
    assert trie.dequantise(np.array([trie.ABSENT], np.uint8))[0] == 0


@pytest.mark.parametrize("part_bytes,hot_share", [(10_000_000, 0.25), (3_000, 0.25), (3_000, 0.01)])
def test_lm_equals_plain_model(spark, part_bytes, hot_share):
    """Base exact; score within quantisation; the same for one shard, many shards and dealt-out hot contexts."""
    draw = random.Random(4)
    texts = [" ".join(draw.choice("the The of a b c d e f g h".split() + [f"w{draw.randrange(60)}"] * 4) for _ in range(draw.randrange(60))) for _ in range(90)]
    docs = helpers.table(spark, texts)
    got = {r["doc_id"]: r for r in lm.score(docs, docs["doc_id"] % 3 != 0, part_bytes=part_bytes, hot_share=hot_share).collect()}
    assert len(got) == len(texts)
    model = helpers.bigram_model(texts, [i % 3 != 0 for i in range(len(texts))])
    for i, t in enumerate(texts):
        n, known, total, base, whole = model(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
        assert abs(r["score"] - whole) <= 0.03 * n


@pytest.mark.parametrize("part_bytes,hot_share", [(3_000, 0.01), (400, 0.02)])
def test_lm_dealt_contexts_keep_their_weight(spark, part_bytes, hot_share):
    """Dealt-out contexts score as whole ones do, also beside one frequent child and where a shard learned no child."""
    draw = random.Random(5)
    texts = [" ".join(f"the {'end' if draw.randrange(2) else f'w{draw.randrange(400)}'}" for _ in range(draw.randrange(1, 40))) for _ in range(90)]
    docs = helpers.table(spark, texts)
    got = {r["doc_id"]: r for r in lm.score(docs, docs["doc_id"] % 3 != 0, part_bytes=part_bytes, hot_share=hot_share).collect()}
    model = helpers.bigram_model(texts, [i % 3 != 0 for i in range(len(texts))])
    for i, t in enumerate(texts):
        n, *_, whole = model(t)
        assert abs(got[i]["score"] - whole) <= 0.03 * n


def test_lm_awkward_rows(spark):
    docs = helpers.awkward(spark)
    out = lm.score(docs, docs["doc_id"].isNotNull(), part_bytes=20_000)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert lm.score(docs.limit(0), docs["doc_id"].isNotNull()).count() == 0
    nothing = lm.score(docs, docs["doc_id"] == -5).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == r["base_score"] for r in nothing)
