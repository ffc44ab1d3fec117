"""Trained operators: held-out accuracy, and the rules around the models."""

from __future__ import annotations

import random
import sys
import zlib
from hashlib import sha256
from itertools import product
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffloom.llm import html, licences, syncmers, toxicity

sys.path.insert(0, str(Path(__file__).parent))
import messy  # noqa: E402

SMALL = "/root/testdata/sf0.001"
LARGE = "/root/testdata/sf0.1"


# --- toxicity --------------------------------------------------------------------


def test_pairs_are_learned():
    """Toxic only where insult and group meet: no sum of single weights can say that."""
    rng = random.Random(1)
    terms = toxicity.Terms()
    rows, labels = [], []
    for _ in range(3_000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(40)}" for _ in range(6)]
        words += ["insult"] * insult + ["group"] * group
        rows.append(terms.of(" ".join(words)))
        labels.append(float(insult and group))
    made = toxicity.fit(rows[:2_500], np.array(labels[:2_500]))
    right = sum((made.score(r) >= 0.5) == bool(y) for r, y in zip(rows[2_500:], labels[2_500:]))
    assert right >= 490
    v = made.factor
    a, b = (toxicity.Terms().of(w)[0] for w in ("insult", "group"))
    assert np.isfinite(v).all() and a != b


def test_pairs_of_words_that_say_nothing_alone():
    """Toxic where just one of two words stands: each is as common in either class."""
    rng = random.Random(3)
    terms = toxicity.Terms()
    rows, labels = [], []
    for i in range(3_000):
        one, other = i % 2, i // 2 % 2
        words = [f"w{rng.randrange(40)}" for _ in range(6)] + ["crowd"] * one + ["plain"] * other
        rows.append(terms.of(" ".join(words)))
        labels.append(float(one != other))
    made = toxicity.fit(rows[:2_400], np.array(labels[:2_400]))
    assert not toxicity._telling(rows[:2_400], np.array(labels[:2_400]))[0][terms.of("crowd plain")].any()
    right = sum((made.score(r) >= 0.5) == bool(y) for r, y in zip(rows[2_400:], labels[2_400:]))
    assert right >= 570


def test_machine_against_pairs():
    rng = np.random.default_rng(2)
    made = toxicity.Machine(0.3, rng.normal(size=toxicity.PLACES), rng.normal(size=(toxicity.PLACES, 3)))
    places = np.array([3, 10, 500, 7000])
    x = made.bias + made.weight[places].sum()
    x += sum(made.factor[a] @ made.factor[b] for i, a in enumerate(places) for b in places[i + 1 :])
    assert abs(made.score(places) - 1 / (1 + np.exp(-x))) < 1e-9


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    out = toxicity.rated(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    toxic = [r for r in held if r["toxic"] == 1]
    clean = [r for r in held if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_toxicity_of_messy_rows(spark):
    docs = messy.frame(spark)
    labels = spark.createDataFrame(
        [(i, i % 2 if i % 3 else None) for i in range(12)] + [(1, 1), (None, 1)], "doc_id long, toxic int"
    )
    out = toxicity.rated(docs, labels).collect()
    assert len(out) == len(messy.rows()) and all(r["score"] is not None for r in out)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.rated(docs, none).collect()} == {0}
    assert toxicity.rated(messy.empty(spark), labels).count() == 0
    kept = toxicity.harmless(docs, toxicity.learn(docs, none))
    assert kept.columns == docs.columns and kept.count() == len(messy.rows())


# --- pages -----------------------------------------------------------------------

PAGE = """<html><body><div class="menu"><a href=x>Home</a> <a href=y>News</a></div>
<div id="cookie-notice">We use cookies. Accept all of them, please.</div>
<div class="content"><h1>A title</h1><p>First  paragraph of the story,
which is long enough to count. It has several sentences, commas, and such.
<p>Second &amp; last paragraph, also with a <b>fair</b> number of words in it.</p>
<script>var x = "<p>no text</p>";</script><div class="advert">Buy now!</div></div>
<div class="sidebar">Popular <a href=z>posts</a></div>
<div class="comments"><p>Nice article, thank you very much for that.</p></div><footer>&copy; me</footer>"""
STORY = (
    "A title\nFirst paragraph of the story, which is long enough to count. It has several sentences, "
    "commas, and such.\nSecond & last paragraph, also with a fair number of words in it."
)


@pytest.fixture(scope="module")
def forest(spark):
    return html.learn(spark.read.parquet(f"{LARGE}/pages.parquet"))


def plain_article(page):
    """What stands between the tags of `article`, block by block."""
    import re
    from html import unescape

    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    inside = re.sub(r"</?b>", "", inside).replace("<br>", " ")
    blocks = (" ".join(unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def test_pages_not_learned_from(spark, forest):
    pages = spark.read.parquet(f"{LARGE}/pages.parquet")
    texts = {r["page_id"]: r for r in html.extracted(pages, forest).collect()}
    same = 0
    for r in pages.collect():
        got = texts[r["page_id"]]
        assert got["url"] == r["url"] and got["n_chars"] == len(got["text"])
        same += got["text"] == plain_article(r["html"])
    assert same >= 0.995 * len(texts)


def test_furniture_by_attributes(forest):
    assert html.main_text(PAGE, forest) == STORY
    assert html.main_text("", forest) == html.main_text(None, forest) == ""


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 9)
        nodes = [html.Node("p", -1, 0)]
        nodes += [html.Node("p", rng.randrange(i), 0) for i in range(1, n)]
        margin = np.array([rng.gauss(0, 2) for _ in range(n)])
        yes, no = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)

        def worth(kept):
            ok = all(not k or i == 0 or kept[nodes[i].parent] for i, k in enumerate(kept))
            return sum(yes[i] if k else no[i] for i, k in enumerate(kept)) if ok else -np.inf

        best = max(worth(kept) for kept in product([False, True], repeat=n))
        assert abs(worth(html.decode(nodes, margin).tolist()) - best) < 1e-9


def test_forest_separates():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2_000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    made = html.fit(x[:1_500], y[:1_500])
    assert ((made.margin(x[1_500:]) > 0) == y[1_500:]).mean() > 0.95


def _sentence(rng):
    words = "the story of a town that grew with its river and then lost it in one long summer".split()
    return " ".join(rng.choice(words) for _ in range(rng.randint(12, 30))).capitalize() + "."


@pytest.mark.parametrize("named", [True, False])
def test_tables_of_pages_without_article_or_main(spark, named):
    """Nothing but div: names of classes teach, or else sentences and links."""
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(60):
        told = [_sentence(rng) for _ in range(rng.randint(3, 8))]
        say = (lambda k: f' class="{k}"') if named else (lambda k: "")
        menu = "".join(f"<div><a href=x>{w}</a></div>" for w in ("Home", "News", "Sport", "Contact us"))
        body = "".join(f"<div>{t}</div>" for t in told)
        foot = f"<div{say('footer')}><a href=z>Imprint</a> <a href=y>Terms of use</a> &copy; 2020</div>"
        rows.append((i, "u", f"<html><body><div{say('menu')}>{menu}</div><div{say('text')}>{body}</div>{foot}</body></html>"))
        want[i] = "\n".join(told)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html.extracted(pages, html.learn(pages, max_pages=40)).collect()}
    assert sum(out[i] == want[i] for i in want) >= 57


def test_forms(forest):
    """A form around the article is a box, any other one is left out."""
    rng = random.Random(9)
    one, other = _sentence(rng), _sentence(rng)
    search = "<form class=search>Search here <input name=q><select><option>all of it</select></form>"
    for open_, close in (("<article>", "</article>"), ("<div class=content>", "</div>")):
        inner = f"{open_}<h1>A title</h1><p>{one}</p><p>{other}</p>{close}"
        for page in (
            f"<body><div class=menu><a href=x>Home</a></div><form id=aspnetForm>{inner}</form>{search}</body>",
            f"<body><form id=aspnetForm><div class=menu><a href=x>Home</a></div>{inner}{search}</form></body>",
            f"<body>{search}{inner}<form>Your name <input> <p>We send a letter a week.</p></form></body>",
        ):
            assert html.main_text(page, forest) == f"A title\n{one}\n{other}"


def test_messy_pages(spark, forest):
    schema = "page_id long, url string, html string, text string, n_chars int, x binary"
    odd = ["<![foo[bar]]><p>x", "<![if !IE]>a<![endif]>", "<![", "<![CDATA[x", "<!", "<!foo [<!ENTITY a 'b'>]>t"]
    odd += ["<p>" * 3_000 + "deep", "<div>" * 400 + "x", "</p></div>", "<a<b>&am &#x41;&copy", "<ul><li>a<li>b", "\x00<p>\x00"]
    rows = [(i, "u", t, "t", 1, b"") for i, t in enumerate(odd)]
    rows += [(None, None, None, None, None, None), (1, "u", "", "", 1, b""), (1, "u", PAGE, "", 1, b"")]
    out = html.extracted(spark.createDataFrame(rows, schema), forest).collect()
    assert len(out) == len(rows) and all(r["text"] is not None for r in out)
    assert out[-1]["text"] == STORY
    empty = spark.createDataFrame([], schema)
    assert html.extracted(empty, html.learn(empty)).count() == 0


# --- licences --------------------------------------------------------------------


@pytest.fixture(scope="module")
def classifier(spark):
    return licences.learn(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_templates_and_wrapped_lines(classifier):
    right = total = 0
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            assert classifier.family(text) == family, text
            words = text.split()
            for at in range(0, len(words) - 12, 6):
                found = classifier.family(" ".join(words[at : at + 14]))
                total += 1
                right += found == family
    assert right >= 0.7 * total


def test_what_is_no_licence(classifier, spark):
    for line in ("My driving licence expired last year.", "the software is provided to the people of the town", ""):
        assert classifier.family(line) == licences.UNKNOWN
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").limit(1_500).collect()
    for r in docs:
        found = licences.spans(r["text"], classifier)
        assert found == licences.spans(r["text"], classifier, plain=True)
        for a, b, _ in found:
            assert "icense" in r["text"][a:b] or "rights reserved" in r["text"][a:b]


def test_notices_inside_paragraphs(classifier):
    before = "We measured the yield of barley over nine seasons in the north and the weather was kind"
    after = "Thanks go to all who carried water uphill during a very long and unusually dry summer that year."
    for notice, family in (
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ):
        for text in (f"{before}. {notice} {after}", f"{before} and was {notice[:-1].lower()} {after.lower()}"):
            (found,) = licences.spans(text, classifier)
            assert found[2] == family and notice[-12:-1].lower() in text[found[0] : found[1]].lower()
    two = f"{before}. Released under the MIT License. {after} Licensed under CC BY-NC 4.0."
    assert [f for _, _, f in licences.spans(two, classifier)] == ["mit", "cc-by-nc"]
    assert licences.spans("MIT License", classifier) == [(0, 11, "mit")]
    assert licences.spans("see SPDX-License-Identifier: MIT in the header of every file", classifier)[0][2] == "mit"
    assert licences.spans(f"{before}. {after}", classifier) == []
    repeated = "Released under the MIT License. " + "tra la " * 30
    assert [f for _, _, f in licences.spans(repeated, classifier)] == ["mit"]
    assert licences.spans(repeated, classifier) == licences.spans(repeated, classifier, plain=True)


def test_licences_of_messy_rows(spark, classifier):
    docs = messy.frame(spark)
    out = licences.scanned(docs, classifier).collect()
    assert len(out) == len(messy.rows()) and {r["n_licences"] for r in out} == {0}
    text = "é\nReleased under the MIT License.\nx\nLicensed under CC BY-NC 4.0."
    one = licences.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string"), classifier).first()
    assert one["families"] == "cc-by-nc,mit" and one["spans"] == "mit:2:33,cc-by-nc:36:64"
    assert licences.scanned(messy.empty(spark), licences.learn(messy.empty(spark))).count() == 0


# --- bounds of what is fitted -----------------------------------------------------


def test_repeated_keys_reach_the_driver_once(spark, monkeypatch):
    rows = [(1, f"text number {i}\nline {i}") for i in range(300)] + [(i, f"other {i}") for i in range(2, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, toxic int")
    pages = docs.selectExpr("doc_id AS page_id", "concat('<article><p>', text, '</p></article>') AS html")
    sizes = []
    real = type(docs).toPandas

    def counted(df):
        sizes.append(len(made := real(df)))
        return made

    monkeypatch.setattr(type(docs), "toPandas", counted)
    lines = []
    monkeypatch.setattr(licences, "fit", lines.extend)
    toxicity.learn(docs, labels)
    html.learn(pages)
    licences.learn(docs)
    assert len(sizes) == 2 and max(sizes) <= 7
    assert 0 < len(lines) <= 8


# --- syncmers --------------------------------------------------------------------


def test_anchors_are_closed_syncmers():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdé😀 ", k=500)) + "ab" * 60
    pieces = syncmers._pieces(syncmers._codes(text), syncmers.K)
    inner = syncmers._mixed(pieces[syncmers.S]).tolist()
    width = syncmers.K - syncmers.S + 1
    want = [
        i
        for i in range(len(text) - syncmers.K + 1)
        if min(inner[i : i + width]) in (inner[i], inner[i + width - 1])
    ]
    hashes, places = syncmers.anchors(text)
    assert places.tolist() == want
    moved = syncmers.anchors("some other beginning " + text)
    assert set(hashes.tolist()) <= set(moved[0].tolist())


def test_anchors_in_pieces(monkeypatch):
    text = "".join(random.Random(6).choices("etaoin ", k=3_000))
    whole = syncmers.anchors(text)
    monkeypatch.setattr(syncmers, "CHUNK", 97)
    parts = syncmers.anchors(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


def test_likeness():
    words = [f"word{i}" for i in random.Random(7).choices(range(300), k=600)]
    text = " ".join(words)
    own = syncmers.kept(syncmers.anchors(text))
    near = syncmers.kept(syncmers.anchors(" ".join(words[:300] + ["inserted"] + words[300:])))
    far = syncmers.kept(syncmers.anchors(" ".join(f"other{i}" for i in range(600))))
    assert syncmers.likeness(own, own) == 1.0 > syncmers.likeness(own, near) > 0.8
    assert syncmers.likeness(own, far) < 0.1
    none = syncmers.kept(syncmers.anchors(""))
    assert syncmers.likeness(none, none) == 1.0 and syncmers.likeness(own, none) == 0.0


def test_passages_of_long_texts():
    """Every anchor is kept, so a passage two long texts share is found in both."""
    for seed in range(6):
        rng = random.Random(seed)
        one, other = ("".join(rng.choices("etaoin shrdlu", k=20_000)) for _ in range(2))
        other = other[:9_000] + one[4_000:4_300] + other[9_300:]
        a, b = (syncmers.kept(syncmers.anchors(t)) for t in (one, other))
        assert set(a[0].tolist()) == set(syncmers.anchors(one)[0].tolist())
        common = set(a[0].tolist()) & set(b[0].tolist())
        assert len(common) >= 10 and syncmers.likeness(a, b) > 0
        assert 4_000 <= min(p for h, p in zip(*a) if int(h) in common)


@pytest.mark.parametrize("rows_per_range", [2, 1_000])
def test_edited_texts(spark, ws, rows_per_range):
    rows = [r for r in messy.rows()]
    ordered = sorted(((r[0] is not None, r[0] or 0, r[1] or ""), r) for r in rows)
    texts = [r[1] or "" for _, r in ordered]
    want = []
    for i, (_, r) in enumerate(ordered):
        own, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        want.append((r[0], len(own), sha256(edited.encode()).hexdigest(), syncmers.fingerprint(own), syncmers.fingerprint(edited)))
    out = syncmers.compared(messy.frame(spark), ws, rows_per_range=rows_per_range).collect()
    got = [tuple(r)[:5] for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert syncmers.compared(messy.empty(spark), ws).count() == 0


@pytest.mark.parametrize("kind", ["string", "smallint", "decimal(12,2)", "date", "double"])
def test_keys_of_any_type(spark, ws, kind):
    rng = random.Random(12)
    rows = [(None if i == 30 else rng.randrange(25), f"text {i % 40} " * rng.randrange(9)) for i in range(120)]
    of = {"string": "concat('d', k)", "date": "date_add(DATE '2020-01-01', k)"}.get(kind, f"CAST(k AS {kind})")
    df = spark.createDataFrame(rows, "k int, text string").selectExpr(f"{of} AS doc_id", "text")
    ordered = df.selectExpr("doc_id", "text", "xxhash64(text) AS h").orderBy("doc_id", "h").collect()
    want = []
    for i, r in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)]["text"]
        half = len(r["text"]) // 2
        edited = r["text"][: len(r["text"]) - half] + after[:half]
        want.append((r["doc_id"], len(r["text"]), sha256(edited.encode()).hexdigest(), syncmers.fingerprint(r["text"])))
    out = syncmers.compared(df, ws, rows_per_range=7)
    assert out.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    assert sorted((tuple(r)[:4] for r in out.collect()), key=str) == sorted(want, key=str)


def test_ranges_are_even_whatever_the_keys(spark, ws):
    """A key that a third of the rows share is cut like others; no two ranges in a task."""
    df = spark.range(12_000).selectExpr("IF(id % 3 = 0, 5, id) AS key", "concat('text ', id) AS text")
    dealt = syncmers.beside_next(df, ws, rows_per_range=1_000)
    tasks = dealt.groupBy(F.spark_partition_id().alias("task"), "range").count().collect()
    assert len({r["task"] for r in tasks}) == len(tasks) == 12
    assert max(r["count"] for r in tasks) <= 2 * 12_000 / 12
    assert dealt.filter("ghost").count() == 12
