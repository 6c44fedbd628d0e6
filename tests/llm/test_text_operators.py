import hashlib
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import label_shards, text_density, toxicity_fst, weak_pii
from riskframe.llm.common import table

CASES = {
    "": "", None: "", "<body></body>": "", "plain text only": "plain text only", "<p>Just text": "Just text",
    '<html><body><header><h1>Site</h1></header><div class="sidebar"><p>x y</p></div><main><h1>T</h1><p>Hello &amp; world</p><form><p>Name</p></form><div class="comments"><p>nice</p></div></main><footer>f</footer></body></html>': "T\nHello & world",
    '<body><div id="nav"><a href=1>a</a></div><div class="post"><h2>Title</h2><div>One  two\n three</div><div>Four<br>five</div></div><div class="cookie-notice">We use</div></body>': "Title\nOne two three\nFour five",
    "<article><header><h1>A</h1><p>by bob</p></header><p>Body text here.</p><aside>no</aside></article>": "A\nBody text here.",
    "<article><h1>T</h1><p><b>T more.<br><p>Next &am one.</p><script>var a='</p>'</script></article>": "T\nT more.\nNext &am one.",
    "<article><p>a</p><p><a href=x>b</a></p><p>" + "long " * 40000 + "</p></article>": "a\nb\n" + "long " * 39999 + "long",
}


@pytest.mark.parametrize("html", list(CASES))
def test_article_text(html):
    assert text_density.article_text(html) == CASES[html]


_TEXT = "A sentence of the article that is long enough to count."
KEPT = {
    f"<body><div class='content has-sidebar'><h1>T</h1><p>{_TEXT}</p></div><div class='sidebar'><p>x y</p></div></body>": f"T\n{_TEXT}",
    f"<body><div class='post no-comments'><h1>T</h1><p>{_TEXT}</p></div></body>": f"T\n{_TEXT}",
    f"<body><form id='aspnetForm'><div class='body'><h1>T</h1><p>{_TEXT}</p></div><div class='left-sidebar'><p>x y</p></div></form></body>": f"T\n{_TEXT}",
    f"<body><div class='sidebar-layout'><h1>T</h1><p>{_TEXT}</p><div class='newsletter'>Sign up</div></div></body>": f"T\n{_TEXT}",
    f"<article><p>{_TEXT}</p><section id='discussion'><h2>Discussion</h2><p>{_TEXT}</p></section><h2 id='related-work'>Related</h2><p id='search-terms'>Terms</p><div id='comments'>nice</div></article>": f"{_TEXT}\nDiscussion\n{_TEXT}\nRelated\nTerms",
    f"<body><div class='ad'>{_TEXT} {_TEXT}</div><article><h1>T</h1><p>Short.</p></article></body>": "T\nShort.",
    "<article><p>The sum is <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> here.</p><svg><text>no</text></svg></article>": "The sum is x+1 here.",
    f"<article><p>{_TEXT}</p><h2>Sources <i>and</i> Notes</h2><ol><li><a href='a'>First title</a></li><li><a href='b'>Second title</a></li><li><a href='c'>Third title</a></li></ol></article>":
        f"{_TEXT}\nSources and Notes\nFirst title\nSecond title\nThird title",
    f"<article><p>{_TEXT}</p><h2>References</h2><p>{_TEXT}</p><ul><li><a href='a'>First title</a></li><li><a href='b'>Second title</a></li><li><a href='c'>Third title</a></li></ul></article>": f"{_TEXT}\nReferences\n{_TEXT}",
    f"<article><p>{_TEXT}</p><h3>More from us</h3><ul><li><a href='a'>First title</a></li><li><a href='b'>Second title</a></li><li><a href='c'>Third title</a></li></ul></article>": f"{_TEXT}\nMore from us",
    f"<body><div class='post'><h1>T</h1><p>{_TEXT}</p></div><div class='comments'><p>{_TEXT}</p><p>{_TEXT}</p><p>{_TEXT}</p></div></body>": f"T\n{_TEXT}",
}


@pytest.mark.parametrize("html", list(KEPT))
def test_names_drop_boilerplate_only(html):
    assert text_density.article_text(html) == KEPT[html]


def test_pages_equal_their_article_elements(spark):
    import html as entities

    rows = text_density.main_text(table(spark, "/root/testdata/sf0.01", "pages")).collect()
    source = {r.page_id: r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    for r in rows:
        blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1])
        lines = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in blocks]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


def test_main_text_awkward(spark):
    pages = spark.createDataFrame([(1, None, None), (1, "u", "<p>x"), (None, "u", "")], "page_id long, url string, html string").withColumn("text", F.lit(3))
    assert [(r.page_id, r.text, r.n_chars) for r in text_density.main_text(pages).collect()] == [(1, "", 0), (1, "x", 1), (None, "", 0)]
    assert text_density.main_text(pages.limit(0)).count() == 0


def test_decomposed_letters_score_as_composed_ones():
    import unicodedata

    m = toxicity_fst.ToxicityModel({"imbécile": 4.0}, {"dégu": 3.0})
    texts = ["Tu es un imbécile, vraiment", "quel dégueulasse, imbécile !", "bonjour à toi", "IMBÉCILE"]
    composed = m.values(pa.array([unicodedata.normalize("NFC", t) for t in texts]))
    assert (composed == m.values(pa.array([unicodedata.normalize("NFD", t) for t in texts]))).all()
    assert composed[0] > 0 and composed[1] > composed[3] > 0 and composed[2] == 0


def test_grammar_scopes():
    m = toxicity_fst.ToxicityModel({"zork": 4.0}, {"blee": 3.0})
    assert m.clause_value("you are a zork") > m.clause_value("what a zork") == 4.0
    assert m.clause_value("you are not a zork") == 0 and m.clause_value("he said zork") < 2
    assert m.clause_value("blees and bleeing") == 6.0 and m.clause_value("we will hurt you") == 0.0 and m.clause_value("them we will kill") > 0


def test_composition_runs_both_machines():
    a = toxicity_fst.scope_marker("N", 1, {"I": "n"}, "INO")
    b = toxicity_fst.scope_marker("n", 1, {"O": "x"}, "INOn")
    state, out = 0, []
    for s in "NIOO":
        state, mark = a.compose(b).arcs[state][s]
        out.append(mark)
    assert "".join(out) == "NnxO"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity_fst.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    caught = sum(r.predicted for r in held if r.toxic == 1) / sum(r.toxic == 1 for r in held)
    wrong = sum(r.predicted for r in held if r.toxic == 0) / sum(r.toxic == 0 for r in held)
    assert caught >= 0.8 and wrong <= 0.01


def test_toxicity_awkward(awkward, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity_fst.toxicity(awkward, labels).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    kept = toxicity_fst.reject(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() == 11
    assert toxicity_fst.toxicity(no_docs, labels.limit(0)).count() == 0


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base(text):
    spans = []
    for no, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                spans.append((m.start(), no, kind, m.end()))
    return sorted(spans)


HARD = ["a@b.com_foo@c.de x@y", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 9.9.9.9.", "4111 1111 1111 1111 and 4111-1111-1111-1111-4 5500005555555559 0000000000000000", "+1 (974) 555-3436. +49 30 1234567890123 +5 ++12345678901",
        "é@ü.de ünï a.b@c-d.e.f @@ q@w..e 😀 z@z.zz", "12" * 9 + " " + "4" * 5000, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" password=dd93acb406f036cedd", "a" * 5000 + "@", "1-" * 4000, "4012888888881881 4012 8888 8888 1881 40128888 8888-1881"]


def test_base_spans_equal_python(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string"))
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = weak_pii.find(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = _base(text[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r.doc_id, joined, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, _, k, _ in want) for kind in BASE)
        assert not joined or set(joined.split(",")) <= set(r.spans.split(","))
    secrets = [s for r in rows if r.doc_id == 10**6 + 6 for s in r.spans.split(",") if s.startswith("secret")]
    assert secrets == ["secret:9:49", "secret:60:78"]


def test_em_finds_the_reliable_labeler():
    truth = [((1, 1, -1), 40), ((1, 1, 1), 40), ((-1, -1, 1), 40), ((-1, -1, -1), 40)]
    p = weak_pii.em(truth)
    assert p[1, 1, -1] > 0.9 and p[-1, -1, 1] < 0.1


def test_pii_awkward(awkward, no_docs):
    rows = weak_pii.find(awkward).collect()
    assert len(rows) == 11 and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert weak_pii.find(no_docs).count() == 0


def _check_shards(rows, n):
    sizes = [sum(r["shard"] == s for r in rows) for s in range(16)]
    assert len(rows) == n and sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s in range(16):
        assert sorted(r.slot for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_shards_balance_and_keep_groups(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    rows = label_shards.label_shards(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    _check_shards(rows, len(text))
    where = {}
    for r in rows:
        raw = (text[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw) and r.law == "rows" and r.grown_shard is None
        where.setdefault(text[r.doc_id], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_shards_split_a_group_larger_than_a_shard(spark):
    docs = spark.range(640).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, F.lit("the same")).otherwise(F.col("id").cast("string")).alias("text"))
    rows = label_shards.label_shards(docs).collect()
    _check_shards(rows, 640)
    assert len({r["shard"] for r in rows if r["size"] == 9}) <= 10


def test_shards_awkward(awkward, no_docs):
    _check_shards(label_shards.label_shards(awkward).collect(), 11)
    assert label_shards.label_shards(no_docs).count() == 0
