"""Fingerprints, page text and secrets against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.llm import fingerprints, html_text, secret_scan

from .conftest import SMALL, WORD


def edited(rows):
    """(doc_id, edited text, next text) by a plain loop over rows in order."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for i, (doc_id, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        yield doc_id, text, text[: len(text) - half] + after[:half], after


def check(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    want = sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edited(rows)), key=str)
    got = fingerprints.fingerprint_edits(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == want
    prints = {t: f"{int(fingerprints.simhash([t.encode()])[0]):016x}" for _, t in rows}
    by_id = {i: t for i, t in rows}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert r.fingerprint == prints[by_id[r.doc_id]]
    return got


def test_fingerprints_of_small_documents(small):
    got = check(small)
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got]) + 0.1


def test_fingerprints_of_odd_documents(spark, odd, none):
    check(odd)
    check(odd.limit(1))
    assert fingerprints.fingerprint_edits(none).count() == 0
    assert fingerprints.simhash([b"", b" \n"]).tolist() == [0, 0]


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    texts = [b"alpha beta gamma", b"beta", "süß alpha".encode()]
    _, one, _ = fingerprints.word_hashes(texts)
    assert one[1] == one[3] and one[0] == one[5] and len(set(one.tolist())) == 4
    monkeypatch.setattr(fingerprints, "SLICE_BYTES", 4)
    assert fingerprints.word_hashes(texts)[1].tolist() == one.tolist()


def test_search_within_a_radius_is_exact(spark):
    pick = random.Random(1)
    base = [pick.getrandbits(64) for _ in range(20)]
    prints = [b ^ sum(1 << p for p in pick.sample(range(64), pick.randrange(7))) for b in base for _ in range(10)] * 2
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in [*signed, None]], "fingerprint long")
    for radius, blocks in ((0, 2), (3, 6), (4, 6)):
        got = {(r.query, r.found, r.distance, r.n) for r in fingerprints.within(table.limit(100), table, radius, blocks).collect()}
        want = {(a, b, ((a ^ b) & ((1 << 64) - 1)).bit_count(), signed.count(b))
                for a in signed[:100] for b in signed if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius}
        assert got == want


def test_near_counts_of_the_query(spark, small):
    from almanac.llm import queries

    rows = queries.op9_simhash_fingerprints(spark, SMALL).collect()
    prints = [int(r.fingerprint, 16) for r in rows]
    assert len(rows) == small.count()
    for r in rows:
        near = sum((int(r.fingerprint, 16) ^ p).bit_count() <= 3 for p in prints) - 1
        assert r.n_near == (near if r.doc_id % 20 == 0 else None)
    assert any(r.n_near for r in rows)


def test_numbers_below(spark):
    pick = random.Random(6)
    for n in (1, 2, 7, 60, 153):
        tops = sorted(pick.randrange(-500, 500) for _ in range(n))
        got = spark.range(-510, 510).select("id", fingerprints._below(tops, F.col("id")).alias("n")).collect()
        assert all(r.n == sum(t < r.id for t in tops) for r in got)


PAGE = (
    "<html><head><title>T t</title><style>p{}</style><script>var a='</p><p>x';</script></head><body>{head}<nav><ul><li><a href='/'>Home page</a></li>"
    "</ul></nav><div class='cookie-notice'><p>We use cookies here</p></div>{open}<h1>A &amp; B</h1><p>First <b>bo</b>ld&nbsp;text\n  here<br>and more."
    "<p>Second paragraph &lt;ok&gt;.</p><div class=\"ad\"><p>Buy this now</p></div><form><p>Your mail</p></form><p>Third one.</p>{close}"
    "<section id='comments'><p>First! Great post indeed</p></section><aside><p>Related</p></aside><footer><p>&copy; us</p></footer></body></html>"
)


def page(**parts):
    out = PAGE
    for name, text in parts.items():
        out = out.replace("{" + name + "}", text)
    return out


@pytest.fixture(scope="module")
def weights(spark):
    return html_text.learn(spark.read.parquet(f"{SMALL}/pages.parquet"))


@pytest.mark.parametrize("parts", [
    {"head": "", "open": "<article>", "close": "</article>"}, {"head": "<header><p>Our site</p></header>", "open": "<main>", "close": "</main>"},
    {"head": "", "open": "<div id='content'>", "close": "</div>"},
])
def test_article_of_a_page(weights, parts):
    assert html_text.main_text(page(**parts), weights) == "A & B\n\nFirst bold text here and more.\n\nSecond paragraph <ok>.\n\nThird one."


def test_best_run_is_the_best():
    pick = random.Random(4)
    for _ in range(200):
        scores = [pick.choice([-3, -1, 0, 1, 2.5]) for _ in range(pick.randrange(12))]
        best = max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))])
        start, stop = html_text.best_run(scores)
        assert sum(scores[start:stop]) == best


def test_pages_of_any_kind(spark, weights):
    rows = [(1, "u", None, 1), (2, None, "", 1), (None, "u", "plain words only", 1), (4, "u", "<p>a < b <unclosed", 1), (5, "u", "<!-- <p>no</p>", 1),
            (6, "u", "<article><p>" + "long words " * 20_000 + "</article>", 1), (6, "u", "<article></article>", 1), (7, "u", "</p></div>&#0;&bogus;", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = {(r.page_id, r.n_chars): r.text for r in html_text.extract(pages, weights).collect()}
    assert len(got) == len(rows) and got[1, 0] == "" and got[2, 0] == "" and len(got[6, 219_999]) == 219_999
    assert html_text.extract(pages.limit(0), weights).count() == 0
    assert html_text.extract(pages, html_text.learn(pages.limit(0))).count() == len(rows)


SECRET = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"


def test_secrets_are_found_and_others_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = secret_scan.findings(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.start : r.start + r.n_chars] == r.value for r in rows)
    accepted = {(r.doc_id, r.value) for r in rows if r.accepted}
    import re

    want = {(i, v) for i, t in texts.items() for v in re.findall(r"(?i)token = \"([0-9a-f]{40})\"", t)}
    assert want and accepted == want


def test_redaction(spark, odd, none):
    out = secret_scan.redacted(odd)
    assert out.schema == odd.schema and out.count() == odd.count()
    before = sorted(((r.doc_id, r.text) for r in odd.collect() if r.doc_id != 12), key=str)
    assert sorted(((r.doc_id, r.text) for r in out.collect() if r.doc_id != 12), key=str) == before
    row = out.where("doc_id = 12").first()
    assert row.text == f'a key: token = "{secret_scan.MASK}" here' and row.n_chars == len(row.text)
    assert secret_scan.redacted(none).count() == 0


def test_starts_and_several_values_in_a_word(spark):
    text = f"ü {SECRET} \t\n token=abcdefghij0123456789;secret=\"Zyxw9876vuts5432\" mail9.example.com/path/{SECRET}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = secret_scan.findings(docs).collect()
    assert len(rows) >= 4 and all(text[r.start : r.start + r.n_chars] == r.value for r in rows)
    assert WORD.findall(text)[0] == "ü"


def test_labelled_findings_decide(spark):
    docs = spark.createDataFrame([(i, f"see abcdef{i:06d}xyz and {i:016d} there") for i in range(60)], "doc_id long, text string")
    found = secret_scan.candidates(docs, [])
    from pyspark.sql import functions as F

    labelled = found.withColumn("label", (F.col("digits_alone") == 0).cast("int"))
    rows = secret_scan.findings(docs, labelled=labelled).collect()
    assert len(rows) == 120 and all(r.accepted == r.value.startswith("abc") for r in rows)


def test_dictionary_is_counted_over_all_documents(spark):
    """Ordinary words of a small source are in it at any size; copies and parts of keys are not."""
    rows = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60))) for i in range(676)]
    rows = [(i, t) for i, t in rows for _ in range(5)]
    rows += [(9_000 + i, f"Plattform, ({i}) kennung. key-{i}=inside{i}outer") for i in range(40)] + [(9_900, "copied words") for _ in range(500)]
    words = {r.word for r in secret_scan.dictionary(spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")).collect()}
    assert words == {"plattform", "kennung"}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.candidates(spark.createDataFrame([(1, "id = plattform_kennung_7")], "doc_id long, text string"), [])
    assert [round(r.covered * r.chars) for r in secret_scan.cover(found, secret_scan.dictionary(docs)).collect()] == [16]


LEARNED = html_text.Weights({}, {})
BODY = " ".join(f"sentence{i} of the story" for i in range(60))


@pytest.mark.parametrize("page", [
    f"<body><article>teaser card</article><div><p>{BODY}</p></div></body>",
    f"<body><main></main><div><p>{BODY}</p></div></body>",
    f"<body><div class='layout has-sidebar'><p>{BODY}</p></div></body>",
    f"<body><article class='post has-comments'><p>{BODY}</p></article></body>",
    f"<body><article><p>Before.</p><section id='related-work'><p>{BODY}</p></section></article></body>",
    f"<body><article><section id='discussion'><p>{BODY}</p></section></article></body>",
    f"<body><form class='form'><p>{BODY}</p></form></body>",
    f"<body><div data-state='not hidden here'><p>{BODY}</p></div></body>",
    f"<body><object><p>{BODY}</p></object></body>",
])
def test_marks_do_not_lose_a_whole_article(page):
    assert BODY in html_text.main_text(page, LEARNED)


def test_marked_elements_are_left_out():
    page = f"<body><p>{BODY}</p><div class='box comments'>one said</div><p hidden>two</p><p aria-hidden='true'>three</p><p style='display: none'>four</p></body>"
    assert html_text.main_text(page, LEARNED) == BODY
