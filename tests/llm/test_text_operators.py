"""The operators that read a document or page at a time, against plain Python or given libraries."""

from __future__ import annotations

import hashlib
import html as html_module
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, compression, decontaminate, html_text, language, quality_rules, queries

SF = "/root/testdata/sf0.001"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, blank, tied, repeated, very long and oddly encoded texts, with columns of the operators' names."""
    rng = random.Random(5)
    words = "the of and to in is der die und le la les el que casa ñandú été groß".split()
    long = " ".join(rng.choice(words) + str(rng.randint(0, 400)) for _ in range(30_000))
    texts = [None, "", " \t\r\n\x0b\x0c", "one", "a b c d", "x " * 40, long, long, "line one is here\n" * 7]
    texts += ["nbsp\xa0joined words\x85here", "### $$$ *** " * 6, "LOUD VOICES SHOUT HERE " * 5, "🙂 split 한국 \x00 nul"]
    texts += [" ".join(f"word{i}###" for i in range(20))]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    rows = [(i if i != 11 else None, t, rng.choice(["en", "de", None]), "s", len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[7])
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit("mine") for c in ("n_words", "failed", "kept", "ids", "decoded", "score", "row", "fp", "n_tokens", "spans", "shard", "at")}
    return df.withColumns(clash)


def measured(text):
    text = text or ""
    words = WHITE.findall(text)
    lines = [x for x in text.split("\n") if WHITE.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_ledger_measures_like_plain_python(odd):
    got = quality_rules.apply_policy(quality_rules.ledger(odd)).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.select("doc_id", "text").collect()}
    assert len(got) == odd.count()
    for r in got:
        own = r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]
        assert own == measured(texts[r["doc_id"]])
        n, *_, repeats = own
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert r["kept"] == (r["failed"] == 0)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["kept"] for r in got)


def test_policies_only_read_the_ledger(spark, odd):
    judged = quality_rules.ledger(odd)
    both = [quality_rules.apply_policy(judged, v).filter("kept").count() for v in (1, 2)]
    assert both[0] > both[1]
    found = {r["rule"]: r for r in quality_rules.ablations(judged).collect()}
    assert found["symbols"]["n_kept_without"] == both[1] + found["symbols"]["n_only"]
    empty = quality_rules.ablations(quality_rules.ledger(odd.limit(0))).collect()
    assert {(r["n_failed"], r["n_only"], r["n_kept_without"]) for r in empty} == {(0, 0, 0)}


def test_ledger_needs_no_shuffle(odd):
    plan = quality_rules.apply_policy(quality_rules.ledger(odd))._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("Physical Plan")[1]


def test_encoding_equals_tiktoken_and_decodes(spark, odd):
    path = public_tokenizers.path(queries.VOCABULARY)
    ranks = byte_bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in odd.select("doc_id", "text").collect()}
    outputs = (*byte_bpe.OUTPUT,)
    found = byte_bpe.encode_and_decode(odd, path, public_tokenizers.PATTERN, outputs)
    assert found.columns[-len(outputs) :] == list(outputs)
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = texts[r["doc_id"]]
        ids = own.encode_ordinary(text)
        assert (r["ids"], bytes(r["decoded"]), r["n_tokens"]) == (ids, text.encode(), len(ids))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert all(0 <= a <= b <= len(text) for a, b in zip(r["starts"], r["ends"], strict=True))
        assert not text or (r["starts"][0], r["ends"][-1]) == (0, len(text))
    assert byte_bpe.encode_and_decode(odd.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_encoding_of_odd_strings_equals_tiktoken():
    path = public_tokenizers.path(queries.VOCABULARY)
    ranks = byte_bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(byte_bpe.tokenizer_json(ranks), public_tokenizers.PATTERN, remembered=50)
    rng = random.Random(1)
    parts = ["a", "aa", " ", "\n", "\t", "!", "=", "é", "ñ", "🙂", "한", "0", "'s", "'", "\x85", "\xa0", "the", "\x1c"]
    texts = [rng.choice(parts) * rng.randint(1, 60) + rng.choice(parts) for _ in range(1500)]
    texts += ["".join(rng.choices(parts, k=20)) for _ in range(1500)]
    for i in range(0, len(texts), 100):
        for text, ids in zip(texts[i : i + 100], codec.encode(texts[i : i + 100]), strict=True):
            assert ids.tolist() == own.encode_ordinary(text)
            assert codec.decode(ids.tolist()) == text.encode()


def contained(docs, items, threshold=0.8):
    words = lambda t: [w.translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})) for w in WHITE.findall(t or "")]
    cut = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    for item, text in items:
        own = words(text)
        width = min(5, len(own))
        for doc, body in docs:
            shared, all_ = len(cut(own, width) & cut(words(body), width)), len(cut(own, width))
            if width and shared >= threshold * all_ - 1e-9:
                yield doc, item, shared, all_


def test_contained_items_equal_brute_force(spark, odd, monkeypatch):
    rng = random.Random(3)
    texts = [r["text"] for r in odd.select("text").collect() if (r["text"] or "").split()]
    items = [(0, None), (1, ""), (2, "One"), (3, "A b C d"), (4, "no such words"), (5, "x x x x x x x")]
    for i in range(6, 40):
        words = rng.choice(texts).split()
        begin = rng.randrange(len(words))
        own = words[begin : begin + rng.randint(3, 60)]
        own[: rng.randint(0, 3)] = ["other"]
        items.append((i, " ".join(own)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    want = sorted(contained(docs, items), key=repr)
    columns = ["doc_id", "item_id", "n_shared", "n_item"]
    got = decontaminate.contained_items(odd, benchmark).select(columns)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert len(want) > 20
    bad = {d for d, *_ in want}
    clean = decontaminate.keep_clean(odd, benchmark)
    assert clean.columns == odd.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in docs if d not in bad)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    got = decontaminate.contained_items(odd, benchmark).select(columns)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert decontaminate.keep_clean(odd, benchmark).count() == clean.count()
    assert decontaminate.contained_items(odd, benchmark.limit(0)).count() == 0
    assert decontaminate.contained_items(odd.limit(0), benchmark).count() == 0


def test_languages_of_held_out_documents(spark):
    rows = queries.languages(spark, "/root/testdata/sf0.01").collect()
    lang = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(held) > 150
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_distance_equals_plain_python(odd):
    profiles = {"a": "_t th the e_ he _th he_".split(), "b": "_d de der r_ er _de er_".split()}
    code = lambda g: sum((1 if c == "_" else ord(c) + 2) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    model = language.Profiles({k: [code(g) for g in v] for k, v in profiles.items()})
    for text in ("the", "Der!", "the der the", "1 2"):
        words = re.findall(r"[a-z]+", text.lower())
        count = {}
        for g in [g for w in words for n in (1, 2, 3) for g in _grams(w, n)]:
            count[g] = count.get(g, 0) + 1
        edges = [g for g in count if g != "_"]
        own = sorted(edges, key=lambda g: (-count[g], code(g)))
        far = {k: sum(abs(v.index(g) - i) if g in v else 300 for i, g in enumerate(own)) for k, v in profiles.items()}
        got = model.nearest(text)
        if not words:
            assert got == ("und", 0.0)
        else:
            assert got[0] == min(far, key=lambda k: (far[k], k))
            assert got[1] == pytest.approx(1 - far[got[0]] / (300 * len(own)))


def _grams(word, n):
    padded = f"_{word}_"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def test_ngrams_do_not_depend_on_stretches():
    rng = random.Random(2)
    for _ in range(40):
        text = "".join(rng.choice("ab c1.É") for _ in range(rng.randint(0, 60)))
        whole = language.ngrams(text)
        count = Counter(g for w in re.findall("[abcé]+", text.lower()) for n in (1, 2, 3) for g in _grams(w, n) if g != "_")
        code = lambda g: sum((1 if c == "_" else ord(c) + 2) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
        want = {}
        for g, n in count.items():
            want[code(g)] = n
        assert dict(zip(whole[0].tolist(), whole[1].tolist(), strict=True)) == want, text
        for stretch in (1, 2, 3, 7):
            part = language.ngrams(text, stretch)
            assert part[0].tolist() == whole[0].tolist() and part[1].tolist() == whole[1].tolist(), (text, stretch)


def test_profiles_equal_plain_counts(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["x", "y"]), " ".join(rng.choices(["abc", "Bcd", "é", "zz9"], k=20))) for i in range(60)]
    rows += [(None, "x", "qqq"), (61, None, "qqq"), (62, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    found = language.learn_profiles(df)
    code = lambda g: sum((1 if c == "_" else ord(c) + 2) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    for lang in ("x", "y"):
        count = Counter()
        for i, own, text in rows:
            if own == lang and i is not None and text:
                count.update(code(g) for w in re.findall("[a-zé]+", text.lower()) for n in (1, 2, 3) for g in _grams(w, n) if g != "_")
        assert found[lang] == sorted(count, key=lambda g: (-count[g], g))[:300]


def test_many_labels_and_long_texts_are_bounded(spark):
    dirty = spark.range(100_000).selectExpr("id AS doc_id", "concat('label ', id) AS lang", "concat('only ', hex(id)) AS text")
    real = spark.range(3000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'en', 'de') AS lang", "if(id % 2 = 0, 'this is the house of them', 'dies ist das haus von ihnen') AS text")
    rows = dirty.unionByName(real)
    found = language.learn_profiles(rows, languages=10)
    assert {"en", "de"} <= set(found) and len(found) == 10
    held = rows.withColumn("doc_id", F.col("doc_id") + 200_000)
    start = time.perf_counter()
    some = language.identify(rows.unionByName(held.filter("lang IN ('en', 'de')").limit(200)), languages=500)
    got = some.filter("doc_id >= 200000").collect()
    assert time.perf_counter() - start < 60
    assert {r["lang_pred"] for r in got} == {"en", "de"}
    model = language.Profiles(found)
    assert model.nearest("this is the house of them " * 300_000)[0] == "en"


def test_language_of_odd_rows(spark, odd):
    found = {r["doc_id"]: r for r in language.identify(odd).collect()}
    assert found[0]["lang_pred"] == found[1]["lang_pred"] == found[2]["lang_pred"] == "und"
    assert found[None]["held_out"] is False
    assert language.identify(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality_scores_of_held_out_documents(spark):
    rows = queries.quality_scores(spark, "/root/testdata/sf0.1").collect()
    label = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 300
    for kind in (0, 1):
        own = [r for r in held if label[r["doc_id"]] == kind]
        assert sum(r["predicted"] == kind for r in own) >= 0.9 * len(own)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_scores_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert compression.score_quality(odd, labels).count() == odd.count()
    assert {r["score"] for r in compression.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert compression.score_quality(odd.limit(0), labels).count() == 0


PAGES = {
    "<article><h1>Head</h1><p>a &amp;  b\n c</p><p>d<b>e</b></p></article>": "Head\na & b c\nde",
    "<nav><a href=x>menu</a></nav><div class='ad'>buy this</div><article><p>Text &lt;x&gt;.</article><footer>f</footer>": "Text <x>.",
    "<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><main><p title=\"a>b\">Yes.</p></main>": "Yes.",
    "<article><p>Story.</p><div class='comments'><article><p>I agree</p></article></div><p>End.</p></article>": "Story.\nEnd.",
    "<article><p>One.</p><aside>side</aside><form><p>mail</p><input></form><p>Two.</p></article>": "One.\nTwo.",
    "<div>Menu</div><div><p>" + "long text " * 12 + "</p><p>" + "more words " * 10 + "</p></div>"
    "<div></div><ul><li><a>x</a></li><li><a>y</a></li><li><a>z</a></li></ul>": None,
    "": "",
    "<p>unclosed <b>tag": "unclosed tag",
    "just < text": "just < text",
}


def test_main_texts():
    for page, want in PAGES.items():
        if want is None:
            want = "long text " * 12
            assert html_text.main_text(page).endswith(f"{want.strip()}\n{('more words ' * 10).strip()}")
        else:
            assert html_text.main_text(page) == want
    assert html_text.main_text("<p>" * 20_000 + "x" * 200_000) == "x" * 200_000


def test_pages_keep_their_articles(spark):
    rows = {r["page_id"]: r for r in queries.page_texts(spark, SF).collect()}
    for page, body in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", body, re.S)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert rows[page]["text"] == "\n".join(b for b in blocks if b)
        assert rows[page]["n_chars"] == len(rows[page]["text"])
    empty = spark.createDataFrame([(1, None, None), (1, None, None)], "page_id long, url string, html string")
    assert [tuple(r) for r in html_text.extract(empty).collect()] == [(1, None, "", 0)] * 2
    assert html_text.extract(empty.limit(0)).count() == 0


LONG = "some words of a long paragraph that goes on and on without any link in it at all"
LINKS = "".join(f"<li><a href=x>link number {i}</a></li>" for i in range(6))


def test_windows_of_lines_decide_with_and_without_articles():
    body = f"<h1>Title</h1><p>{LONG}</p><p>ab</p><p>{LONG}</p>"
    text = f"Title\n{LONG}\nab\n{LONG}"
    menu = "<ul><li>Home</li></ul>" + f"<ul>{LINKS}</ul>"
    tail = f"<ul>{LINKS}</ul><div>tel</div><div>fax</div><div>imprint</div>"
    assert html_text.main_text(f"<body>{menu}<div class=content>{body}</div>{tail}") == text
    for region in ("article", "main"):
        assert html_text.main_text(f"<body>{menu}<{region}>{body}</{region}>{tail}") == text
    teaser = "<article><h3><a href=x>Read on</a></h3><p>A teaser.</p></article>"
    assert html_text.main_text(f"<body>{menu}<div class=content>{body}{body}</div><ul>{LINKS}</ul>{teaser}") == f"{text}\n{text}"
    assert html_text.main_text(f"<main>{body}<ul>{LINKS}</ul><p>{LONG}</p><p>{LONG}</p></main>") == f"{text}\n{LONG}\n{LONG}"
    both = html_text.main_text(f"<article>{body}</article><div>x</div><div>y</div><ul>{LINKS}</ul><div><p>{LONG}</p></div>")
    assert both.endswith(LONG) and both.count(LONG) == 3
    short = "<article><p>a b</p><p>c d</p><p>e f</p><p>g h</p><p><a href=x>source</a></p><p>i j</p></article>"
    assert html_text.main_text(short) == "a b\nc d\ne f\ng h\nsource\ni j"
    assert html_text.main_text("<article>Short text without paragraphs.</article>") == "Short text without paragraphs."


def test_dropped_elements_end_where_html_ends_them():
    ends = {
        "<article><p>One.<p class=ad>Buy<p>Two.</article>": "One.\nTwo.",
        "<article><p>One.<p class=ad>Buy<h2>Head</h2><p>Two.</article>": "One.\nHead\nTwo.",
        "<article><ul><li>One<li class=ad>Buy<div>this</div><li>Two</ul><p>Three.</article>": "One\nTwo\nThree.",
        "<article><ul><li>One<li class=ad>Buy<ul><li>a<li>b</ul><li>Two</ul></article>": "One\nTwo",
        "<article><dl><dt>One<dd class=ad>Buy<dt>Two<dd>Three</dl></article>": "One\nTwo\nThree",
        "<article><table><tr><td>One<td class=ad>Buy<td>Two<tr class=ad><td>x<td>y<tr><td>Three</table></article>": "One\nTwo\nThree",
        "<article><div><p>One.</p><div class=ad>Buy<div>this</div><p>Two.</article><p>Three.</p>": "One.\nThree.",
        "<article><section><aside>side<p>x</section><p>Two.</article>": "Two.",
        "<article><p>One <span class=ad>Buy <span>this</span> now</span> two</article>": "One\ntwo",
        "<article><p>One <span class=ad>Buy</p><p>Two.</article>": "One\nTwo.",
        "<head><title>t</title><meta charset=x><body><p>One.": "One.",
        "<article><p>One <button><p>x</p></button> two</article>": "One\ntwo",
    }
    for page, want in ends.items():
        assert html_text.main_text(page) == want, page
    start = time.perf_counter()
    for part in ("<div class=ad>", "<p class=ad>", "<span class=ad><div>", "<li><b></i>", "<table><td></div>", "<section></li>"):
        html_text.main_text(part * 30_000)
    assert time.perf_counter() - start < 30


def test_names_drop_no_articles_wrappers_or_main_texts():
    body = f"<p>{LONG}</p>" * 6
    text = "\n".join([LONG] * 6)
    for tag, names in {
        "article": ("post comments-open", "post category-social", "ad", "widget"),
        "main": ("has-sidebar", "sidebar", "with-comments"),
        "div": ("layout no-sidebar", "has-sidebar", "tag-promo", "category-ad", "layout sidebar", "content widget"),
    }.items():
        for name in names:
            assert html_text.main_text(f"<{tag} class='{name}'>{body}</{tag}>") == text, name
            assert html_text.main_text(f"<{tag} id='{name.split()[-1]}'>{body}</{tag}>") == text, name
    assert html_text.main_text(f"<form action=x id=page>{body}</form>") == text
    holder = "<div class='social'><p>Before.</p><article><p>In it.</p></article></div>"
    assert html_text.main_text(holder) == "Before.\nIn it."
    assert html_text.main_text(f"<main><div class=widget><article>{body}</article></div></main>") == text
    for name in ("ad", "comments", "sidebar", "site-footer", "siteFooter", "AD", "share_buttons", "box ad"):
        assert html_text.main_text(f"<article>{body}</article><div class='{name}'><p>{LONG}</p></div>") == text, name
    reader = f"<div id=comments><div><article>{body}</article></div>{body * 2}</div>"
    assert html_text.main_text(f"<article>{body}</article>{reader}") == text


def test_quotes_and_short_or_linked_texts_are_not_lost():
    first, second = "FIRST is a paragraph", "It's the SECOND one, isn't it"
    pages = {
        f"<p data-x=don't>{first}</p><p>{second}</p>": f"{first}\n{second}",
        f"<p it's title='a>b' x=\"c'>d\">{first}</p><p data-y=a\"b>{second}</p>": f"{first}\n{second}",
        f"<p a=1 b = '2' c=\"3\"/>{first}</p ><p/>{second}</p x='>'>": f"{first}\n{second}",
        f"<p>{first}<!-- > -- <p> --><!--> {second}<!--->.<!-- x --!>!<? php ?><!x><//>": f"{first} {second}.!",
        f"<p>{first}</p><p title='never closed>{second}</p>": first,
        f"<p>{first}</p><p {second}": first,
        f"<p>{first}</p><script>let a = '</p>' + \"<script>\"; </scripts></script ><p>{second}</p>": f"{first}\n{second}",
        f"<p>{first}</p><script>{second}</p>": first,
        f"<p>{first}</p><select><option>one<option>two</select><svg><text>x</text></svg><p>{second}": f"{first}\n{second}",
        f"<p>5 < 6 <3 and a<-b</p><p>{second} </p> <": f"5 < 6 <3 and a<-b\n{second}\n<",
        "<div class='post'><div>Short body, sixty characters or so in a plain page.</div></div>": "Short body, sixty characters or so in a plain page.",
        "<div><a href=x>Home</a> <a href=y>About</a></div><div>Short.</div>": "Short.",
        f"<article><p>{LONG}</p><p><a>A whole link, as a sentence.</a></p><p><a>And another one.</a></p><p>{LONG}</p></article>": f"{LONG}\nA whole link, as a sentence.\nAnd another one.\n{LONG}",
        f"<div><p>{LONG}</p><p>Yes.</p><p>No.</p><p>So.</p><p>Ok.</p><p>{LONG}</p></div>": f"{LONG}\nYes.\nNo.\nSo.\nOk.\n{LONG}",
        f"<div><p>By me.</p><p>{LONG}</p><p>No.</p><p>So.</p></div><div>tel</div><div>fax</div>": f"By me.\n{LONG}\nNo.\nSo.",
    }
    for page, want in pages.items():
        assert html_text.main_text(page) == want, page


def test_size_alone_never_decides_what_stays():
    for n in (10, 79, 80, 399, 400, 5_000):
        text = ("word " * n)[: n - 1] + "."
        assert html_text.main_text(f"<form><p>{text}</p></form>") == text
        assert html_text.main_text(f"<h1>Title</h1><div class=sidebar><p>{text}</p></div>") == f"Title\n{text}"
        for name in ("user-comments", "advert-block", "cookie-consent-bar", "left-sidebar", "adBox", "site_footer top", "post-navigation", "x newsletter-box"):
            page = f"<div class=body><p>{LONG}</p></div><div class='{name}'><p>{text}</p></div>"
            assert html_text.main_text(page) == LONG, (name, n)
            assert html_text.main_text(page.replace(" class='", " id='")) == LONG, (name, n)
        for name in ("no-sidebar", "has-comments", "comments-open", "tag-menu", "category-social-news", "with-ads", "hide-banner", "headed", "shareholders"):
            page = f"<div class=body><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div><p>{text}</p></div>"
            assert html_text.main_text(page).startswith(f"{LONG}\n{LONG}"), name
        comment = f"<article class='comment'><p>{text}</p></article>"
        assert html_text.main_text(f"<article><p>{LONG}</p>{comment}</article>") == LONG
        assert html_text.main_text(f"<div class=body><p>{LONG}</p></div><section id=comments>{comment}</section>") == LONG


def test_broken_markup_takes_time_in_proportion():
    parts = ["<script ", '<a "x ', "<a ", "<a b='", '<a b="c" ', "<!--", "</", "<!", "<?", "</a b", "<title>", "<p class=ad x=", "<a b=c' d=\"e ", "<script></scrip"]
    nested = ["<div class=ad><a>x</a>", "<div class=sidebar>x", "<form><h1>x</h1>", "<div class=comments><article>x", "<section><p>x<div id=menu>", "<svg><select>", "<div class=sidebar><p>one two three four</p>"]
    for part in parts:
        start = time.perf_counter()
        html_text.main_text(part * 100_000)
        html_text.main_text(f"<p>{LONG}" + part * 100_000)
        assert time.perf_counter() - start < 4, part
    for part in nested:
        start = time.perf_counter()
        html_text.main_text(part * 20_000)
        html_text.main_text("<p>x</p>" + part * 20_000 + f"<p>{LONG * 900}")
        assert time.perf_counter() - start < 12, part


class PlainTokens(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found = []

    def handle_starttag(self, tag, attrs):
        first = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        self.found.append(("open", tag, first))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.found.append(("close", tag))

    def handle_data(self, data):
        self.found.append(("text", data))

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def joined(found):
    """Texts that follow each other as one; the content of raw elements isn't text of the page."""
    out, raw = [], None
    for token in found:
        if raw and token[0] == "text":
            continue
        raw = token[1] if token[0] == "open" and token[1] in html_text.RAW else None
        if token[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + token[1])
        else:
            out.append(token)
    return out


def random_markup(rng):
    names = ["p", "div", "a", "B", "script", "style", "br", "x-y"]
    values = ["", "=1", "=a'b", "='q w'", '="it\'s > <p>"', "=a/b", " = 'x'"]
    parts = []
    for _ in range(rng.randint(1, 25)):
        name = rng.choice(names)
        attributes = "".join(f" {rng.choice(['id', 'Class', 'data-x', 'y'])}{rng.choice(values)}" for _ in range(rng.randint(0, 3)))
        kind = rng.randrange(5)
        if name in ("script", "style"):
            parts.append(f"<{name}{attributes} >var x = '<p>'; a </{name}>")
        elif kind == 0:
            parts.append(f"</{name}>")
        elif kind == 1:
            parts.append(f"<!-- {rng.choice(['x', '<p>', 'a > b'])} -->")
        elif kind == 2:
            parts.append(rng.choice(["text ", "a &amp; b", "1 < 2 ", "&#65;", "\n"]))
        else:
            parts.append(f"<{name}{attributes}{rng.choice(['', ' ', ' /'])}>")
    return "".join(parts)


def test_tokens_equal_those_of_a_plain_parser():
    rng = random.Random(12)
    for _ in range(1500):
        page = random_markup(rng)
        parser = PlainTokens()
        parser.feed(page)
        parser.close()
        own = [(what, name, found) if what == "open" else (what, name) for what, name, found, _ in html_text.tokens(page)]
        own = [(w, n, {k: html_module.unescape(v) for k, v in rest[0].items()}) if rest else (w, n) for w, n, *rest in own]
        assert joined(own) == joined(parser.found), page


def plain_main_text(blocks, region):
    """The rules again, line by line: ``blocks`` are (tag, text, text in links, container)."""
    total = sum(len(t) for _, t, linked, _ in blocks if not linked)
    sizes = [0 if linked else len(t) for _, t, linked, _ in blocks]
    inside = [region is not None and c == region for *_, c in blocks]
    share = sum(s for s, r in zip(sizes, inside, strict=True) if r) / max(1, total)
    weights = [s + (30 * share * s / len(b[1]) if r else 0) for s, r, b in zip(sizes, inside, blocks, strict=True)]
    sums = [sum(weights[j] for j in range(len(blocks)) if abs(i - j) <= 1) for i in range(len(blocks))]
    state, runs = None, []
    for i in range(len(blocks) + 1):
        if state is None and i < len(blocks) and sums[i] >= 80:
            state = i
            while state > 0 and inside[state - 1] and sums[state - 1] >= 25 and (not runs or state > runs[-1][1]):
                state -= 1
        elif state is not None and (i == len(blocks) or sums[i] < 25):
            runs.append([state, i])
            state = None
    same = lambda i, j: weights[i] > 0 and blocks[i][3] == blocks[j][3]
    changed = True
    while changed:
        changed = False
        for k in range(len(runs) - 1):
            (_, b), (c, d) = runs[k], runs[k + 1]
            if blocks[b - 1][3] == blocks[c][3] and all(same(i, c) for i in range(b, c)):
                runs[k : k + 2] = [[runs[k][0], d]]
                changed = True
                break
    for k, run in enumerate(runs):
        low = runs[k - 1][1] if k else 0
        while run[0] > low and blocks[run[0]][3] and same(run[0] - 1, run[0]) and blocks[run[0] - 1][0] == "p":
            run[0] -= 1
    for k, run in enumerate(runs):
        high = runs[k + 1][0] if k + 1 < len(runs) else len(blocks)
        while run[1] < high and blocks[run[1] - 1][3] and same(run[1], run[1] - 1) and blocks[run[1]][0] == "p":
            run[1] += 1
    kept = set()
    for a, b in runs:
        for i in range(a, b):
            near = any(weights[a:i]) and any(weights[i + 1 : b])
            alone = i > a and i + 1 < b and weights[i - 1] and weights[i + 1]
            if weights[i] or (inside[i] and near and (alone or blocks[i][0] == "p")):
                kept.add(i)
    if not runs:
        kept = {i for i, b in enumerate(blocks) if weights[i] or (inside[i] and b[0] != "li")}
    for i in reversed(range(len(blocks) - 1)):
        if blocks[i][0] == "h2" and i + 1 in kept and (weights[i] or inside[i]):
            kept.add(i)
    return "\n".join(blocks[i][1] for i in sorted(kept))


@pytest.mark.parametrize("region", ["article", "main", None])
def test_main_texts_equal_plain_rules(region):
    rng = random.Random(31)
    for _ in range(2000):
        page, blocks, number = ["<body><nav><p>menu</p></nav>"], [], 0
        for part in range(rng.randint(1, 4)):
            holder = rng.choice(["div", "section", "body", region or "div"])
            is_region = holder == region and region not in "".join(page)
            if holder == region and not is_region:
                holder = "div"
            number += holder != "body"
            place = number if holder != "body" else 0
            page.append(f"<{holder}>" if place else "")
            for _ in range(rng.randint(0, 7)):
                tag = rng.choice(["p", "p", "p", "li", "h2"])
                text = f"{len(blocks)} " + "w " * rng.choice([1, 3, 9, 14, 45, 70]) + "."
                linked = rng.random() < 0.25
                page.append(f"<{tag}><a>{text}</a></{tag}>" if linked else f"<{tag}>{text}</{tag}>")
                blocks.append((tag, text, linked, place, is_region))
            page.append(f"</{holder}>" if place else "")
        own = next((c for *_, c, r in blocks if r), None)
        want = plain_main_text([b[:4] for b in blocks], own)
        assert html_text.main_text("".join(page)) == want, "".join(page)


def test_repeated_ids_do_not_add_rows_to_learn_from(spark):
    labels = spark.createDataFrame([(7, 1)] * 3000 + [(i, 0) for i in range(100, 140)] + [(8, 1), (9, 1), (9, 0)], "doc_id long, quality int")
    texts = [(7, "the same text")] * 3000 + [(8, f"text number {i}") for i in range(3000)] + [(9, "two labels")]
    docs = spark.createDataFrame(texts + [(i, f"bad {i}") for i in range(100, 140)], "doc_id long, text string").repartition(6)
    found = compression.chosen(docs, labels, 100)
    good = [r for r in found if r[2] == 1]
    assert sorted(r for r in found if r[2] == 0) == sorted([(i, f"bad {i}".encode(), 0) for i in range(100, 140)] + [(9, b"two labels", 0)])
    assert len(set(good)) == len(good) and 50 < len(good) < 160
    assert len(compression.chosen(docs.filter("doc_id <> 8"), labels, 100)) == 43


def test_repeated_items_travel_once_and_match_each_time(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(decontaminate, "ROWS", 100, raising=False)
    hot = "a question of the benchmark that is in it many times"
    items = [(1, hot)] * 700 + [(None, hot)] * 5 + [(2, hot)] + [(i, f"item {i} of the others with words {i * 7} and {i}") for i in range(3, 150)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    docs = spark.createDataFrame([(1, f"before {hot} after"), (None, hot), (3, "nothing")], "doc_id long, text string")
    blocks = [block for block, _ in decontaminate._blocks(benchmark)]
    assert sum(len(b) for b in blocks) == 150
    assert len(blocks) > 1 and max(sum(len(t) for _, t, *_ in b) for b in blocks) < 2 * decontaminate.BLOCK_BYTES
    got = sorted((tuple(r) for r in decontaminate.contained_items(docs, benchmark).select("doc_id", "item_id").collect()), key=repr)
    assert got == sorted([(d, i) for d in (1, None) for i, t in items if t == hot], key=repr)
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()] == [3]
