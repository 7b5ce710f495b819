"""Personal data, URLs, pages, toxicity and the language model against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, DOCUMENTS, sentence, tricky_rows
from txnmart.llm import html_text, language_model, privacy, toxicity, url_rules


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def plain_spans(text: str) -> list[tuple]:
    def luhn(number: str) -> bool:
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(number[::-1])]
        return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0

    def spans(kind, pattern, right):
        return [(kind, *m.span()) for m in re.finditer(pattern, text) if right(m[0])]

    return [
        *spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        *spans("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        *spans("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        *spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]


def test_base_spans_match_patterns():
    draw = random.Random(4)
    for _ in range(20_000):
        text = "".join(draw.choice("a1.@-+ 0%(é") for _ in range(draw.randrange(40)))
        found = [(kind, *span) for kind, spans in privacy.base_spans(text).items() for span in spans]
        assert found == plain_spans(text), text


def test_personal_data(tricky):
    rows = privacy.find(tricky).collect()
    expected = Counter()
    for row in tricky_rows():
        spans = plain_spans(row[1] or "")
        expected[row[0], privacy.listed(spans), *(sum(s[0] == kind for s in spans) for kind in privacy.KINDS)] += 1
    assert Counter((r["doc_id"], r["base"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in rows) == expected
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) == 4


def test_disclosing_terms(table):
    """A code name that occurs with one address only is removed; common words and clean texts stay."""
    texts = [f"{sentence(i, 3)} Zanzibar {sentence(i + 50, 2)} jo@mail.example.com the {sentence(i + 90, 3)}" for i in range(4)]
    texts += [f"the {sentence(200 + i, 8)} the" for i in range(40)]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS)
    found = privacy.find(docs)
    for row in found.collect():
        text = texts[row["doc_id"]]
        terms = {(kind, text[int(a) : int(b)]) for kind, a, b in (s.split(":") for s in row["spans"].split(",") if s)}
        if row["doc_id"] < 4:
            assert {("email", "jo@mail.example.com"), ("removed", "Zanzibar")} <= terms
            assert not any(word == "the" for _, word in terms)
        else:
            assert terms == set()
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs, found).collect()}
    assert all("Zanzibar" not in clean[i] and "[email]" in clean[i] for i in range(4))
    assert all(clean[i] == texts[i] for i in range(4, 44))


def test_disclosure_share_by_brute_force(table):
    """Every pair's share against counts over the raw texts."""
    draw = random.Random(8)
    texts = []
    for _ in range(120):
        words = [draw.choice(["red", "blue", "oak", "elm", "fir", "ash", "yew"]) for _ in range(6)]
        if draw.random() < 0.4:
            words.insert(draw.randrange(6), draw.choice(["ann@x.example.com", "bob@x.example.com"]))
        texts.append(" ".join(words))
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS)
    found = privacy.disclosures(privacy.scan(docs).persist(), docs, least=-9.0).collect()
    near, of = {}, {}
    for text in texts:
        for match in re.finditer(r"\w+@x\.example\.com", text):
            around = text.replace(match[0], "").split()
            for term in set(around):
                near.setdefault((match[0], term), set()).add(tuple(around))
            of.setdefault(match[0], set()).add(tuple(around))
    expected = {}
    for (entity, term), contexts in near.items():
        have = sum(term in text.split() for text in texts)
        if len(contexts) >= 2:
            told = math.log(len(texts) * min(len(contexts), have) / (have * len(of[entity])))
            key = privacy._hash(f"email:{entity}"), privacy._hash(term)
            expected[key] = told / math.log(len(texts) / len(of[entity]))
    assert {(r["entity"], r["term"]): pytest.approx(r["share"]) for r in found} == expected


def test_disclosure_counts_copies_once(table):
    """A name that goes with one address only keeps its full share, however many copies one of its texts has."""
    texts = [f"{sentence(1, 6)} Zanzibar jo@mail.example.com"] * 90 + [f"{sentence(2, 6)} Zanzibar jo@mail.example.com"]
    texts += [sentence(100 + i, 9) for i in range(40)]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS)
    found = privacy.disclosures(privacy.scan(docs).persist(), docs, least=-9.0).collect()
    shares = {(r["entity"], r["term"]): r["share"] for r in found}
    assert shares[privacy._hash("email:jo@mail.example.com"), privacy._hash("zanzibar")] == pytest.approx(1.0)


def marked(row, text):
    spans = (s.split(":") for s in row["spans"].split(",") if s)
    return {(kind, text[int(a) : int(b)]) for kind, a, b in spans if kind in ("removed", "generalised")}


@pytest.mark.parametrize("others", [40, 1500])
def test_disclosure_by_single_and_far_terms(table, others):
    """A term of one text is rated beside the entity only, alike at any size of the corpus; one of several texts at any distance."""
    far = " ".join(f"common{i}" for i in range(30))
    once = [f"Zanzibar {far} Samarkand jo@mail.example.com {far}"] + [f"{far} al@mail.example.com Timbuktu {far} Lhasa"] * 2
    twice = [f"Nairobi {far} {i} {far} max@mail.example.com" for i in ("common1", "common2")]
    texts = once + twice + [f"{far} {sentence(i, 5)} {i // 15}" for i in range(others)]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS)
    expected = [{("generalised", "Samarkand")}, *[{("generalised", "Timbuktu")}] * 2, *[{("removed", "Nairobi")}] * 2]
    for row in privacy.find(docs).collect():
        assert marked(row, texts[row["doc_id"]]) == (expected[row["doc_id"]] if row["doc_id"] < 5 else set())


def test_disclosing_spans_by_brute_force(table):
    """All spans of terms, with several entities and copies, against counts over the raw texts."""
    draw = random.Random(12)
    names = [f"{name}@x.example.com" for name in ("ann", "bob", "cid", "dan")]
    texts = []
    for _ in range(150):
        words = [f"w{int(draw.paretovariate(0.5)) % 400}" for _ in range(25)]
        if draw.random() < 0.15:
            for name in draw.sample(names, draw.randrange(1, 3)):
                words.insert(draw.randrange(len(words)), name)
        texts.append(" ".join(words))
    texts += texts[:30]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS, 3)
    different = sorted(set(texts))
    have = {text: {w for w in text.split() if "@" not in w} for text in different}
    hold = {text: {w for w in text.split() if "@" in w} for text in different}
    n, found = len(different), 0
    for row in privacy.find(docs).collect():
        text = texts[row["doc_id"]]
        words = text.split()
        terms = [w for w in words if "@" not in w]
        expected = set()
        for term in set(terms):
            best = -9.0
            for name in hold[text]:
                of, known = sum(name in hold[t] for t in different), sum(term in have[t] for t in different)
                both = sum(name in hold[t] and term in have[t] for t in different)
                share = math.log(n * both / (known * of)) / math.log(n / of)
                place = len([w for w in words[: words.index(name)] if "@" not in w])
                if both == 1:
                    share = min(share, privacy.SINGLE) if term in terms[max(0, place - privacy.NEAR) : place + privacy.NEAR] else -9.0
                best = max(best, share)
            if best >= privacy.GENERALISE:
                expected.add(("removed" if best >= privacy.REMOVE else "generalised", term))
        assert marked(row, text) == expected
        found += len(expected)
    assert found > 20


def test_long_contact_list(table):
    """Two versions of a list of 4,000 entities among 4,000 terms: groups meet, not 16 million pairs."""
    listed = " ".join(f"person{i} p{i}@mail.example.com" for i in range(4000))
    texts = [listed, listed + " new"] + [sentence(i, 9) for i in range(30)]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS)
    scanned = privacy.scan(docs).persist()
    rated = privacy.rate(scanned, docs)
    assert rated.groups.count() == 2 and rated.shares.count() == 1
    rows = {r["doc_id"]: r for r in privacy.find(docs).collect()}
    assert marked(rows[1], texts[1]) == {("removed", f"person{i}") for i in range(4000)} | {("generalised", "new")}


def test_hot_text_counts_once(table):
    """A text that many rows share makes its pairs once; all its copies get its spans."""
    hot = "Zanzibar jo@mail.example.com is " + sentence(1, 40)
    texts = [hot] * 400 + ["Zanzibar jo@mail.example.com at home", *(sentence(50 + i, 12) for i in range(60))]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS, 4)
    rated = privacy.rate(privacy.scan(docs).persist(), docs)
    assert rated.texts.count() == 2 and rated.groups.groupBy("_text").count().count() == 2
    rows = privacy.find(docs).collect()
    assert len(rows) == len(texts)
    assert all(("removed", "Zanzibar") in marked(r, texts[r["doc_id"]]) for r in rows if r["doc_id"] <= 400)


def test_privacy_empty(table):
    assert privacy.find(table([], DOCUMENTS)).collect() == []


URLS = [None, "", "no scheme", "HTTP://EXAMPLE.org", "http://a.Example.ORG/en/123?x", "https://xexample.org/es/1", "http://example.org/es/a#b"]
URLS += ["http://b.com/fr/x", "http://com/de/", "http://b.com/de", "http://casino-win.net/", "http://net/?casino", "x://y://z.org/"]
URLS += ["http://host.net/a/b/poker.html", "http://pokers.net/", "http://b.com/FR/x", "http://example.org/es/1"]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_rules.HOST_RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and len(rule) > len(best[1] if best else ""):
            best = verdict, rule
    hit = sorted(w for w in url_rules.UNWANTED if w in re.split("[^0-9a-z]+", (host + path).lower()))
    return host, path, best and best[1], best[0] if best else "block" if hit else "allow", hit


def test_url_rules(table):
    columns = f"page_id long, url string, html string, {CLASHING}, host string, word string, name string"
    extra = ("f", 0, "d", 1, 1, 1, True, 1, "q", "h", "w", "n")
    pages = table([(i % 15, url, None, *extra) for i, url in enumerate(URLS)], columns)
    rows = url_rules.judge(pages).collect()
    found = Counter((r["host"], r["path"], r["rule"], r["verdict"], tuple(r["patterns"])) for r in rows)
    assert found == Counter((*plain_verdict(url)[:4], tuple(plain_verdict(url)[4])) for url in URLS)


def test_url_rules_are_keyed_by_the_rarest_word(spark):
    words = spark.createDataFrame([(w,) for w in ["org"] * 5 + ["example"] * 2 + ["es"] * 3 + ["com"]], "word string")
    keys = {(r["name"], r["kind"]): r["word"] for r in url_rules.index(words).collect()}
    assert keys["example.org/es/", "host"] == "example" and keys["com/de/", "host"] == "de" and keys["org/", "host"] == "org"
    assert keys["example.org/en/1", "host"] == "en"


def test_url_rules_without_words(table):
    rules = [*url_rules.RULES, url_rules.Rule("digits", "pattern", "block", r"[0-9]{5}", ())]
    pages = table([(1, "http://a.net/123456"), (2, "http://a.net/x")], "page_id long, url string")
    assert {(r["page_id"], r["verdict"]) for r in url_rules.judge(pages, rules).collect()} == {(1, "block"), (2, "allow")}


def test_url_rules_empty(table):
    assert url_rules.judge(table([], "page_id long, url string")).collect() == []


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_longest():
    draw = random.Random(2)
    for _ in range(2000):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(14))] for _ in range(2))
        chosen = [a[i] for i in sorted(html_text.aligned(a, b))]
        rest = iter(b)
        assert all(item in rest for item in chosen) and len(chosen) == lcs(a, b)


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1></header><p><b>First   par<br>agraph.<p>Second
 &eacute;&nbsp;one.</p><!-- <p>gone</p> --><div class="share-box social">Share</div><form><input>Send</form>
<section id="comments"><p>Reader says</p></section><p class="notice">Note</p><p>Third</article><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_article_lines():
    text = html_text.main_lines(html_text.lines(ARTICLE), None)
    assert text == ["Head & line", "First par agraph.", "Second é one.", "Third"]


WRAPPED = [
    "<body class='no-sidebar'><p>Text</p></body>",
    "<body><div id='content' class='with-sidebar'><div class='share'>Share</div><article><p>Text</p></article></div></body>",
    "<div class='with-sidebar'><main class='search'><section class='promo'><article class='related-topic'><p>Text</p></article></section></main></div>",
    "<div style='overflow:hidden'><p>Text</p></div>",
    "<div aria-hidden='false' data-hidden=no><p>Text</p></div><div style='color:red; Display : none'>gone</div><div HIDDEN=''>gone</div>",
    "<article><p>Text</p><section id='comments'><article><p>Reader</p></article></section></article>",
    "<aside><article>gone</article></aside><nav class='menu'><main>gone</main></nav><p>Text</p>",
]


@pytest.mark.parametrize("page", WRAPPED)
def test_wrappers_are_no_chrome(page):
    assert html_text.main_lines(html_text.lines(page), None) == ["Text"]


def test_page_differencing(table):
    def page(*own):
        return "<body><div>Top bar</div><div>Login</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Imprint</div></body>"

    rows = [
        (1, "http://a.org/p/1", page("one", "two")),
        (2, "http://a.org/p/2", page("three")),
        (3, "http://b.org/", page("lone")),
        (4, None, None),
        (5, "http://c.org/x", "<article><p>Same</p></article>"),
        (6, "http://c.org/y", "<article><p>Same</p></article>"),
        (7, "http://d.org/", "<p>" + "word " * 50_000),
        (7, "http://d.org/", "<p>" + "word " * 50_000),
    ]
    found = html_text.extract(table(rows, "page_id long, url string, html string", files=1).coalesce(1)).collect()
    text = {r["page_id"]: r["text"] for r in found}
    assert len(found) == 8
    assert text[1] == "one\ntwo" and text[2] == "three"
    assert text[3] == "Top bar\nLogin\nlone\nImprint" and text[4] == ""
    assert text[5] == text[6] == "Same"
    assert [len(r["text"]) for r in found if r["page_id"] == 7] == [249_999] * 2


def test_copies_of_pages_keep_their_text(table):
    def page(own):
        return f"<body><div>Top bar</div><p>{own}</p><div>Imprint</div></body>"

    rows = [(at, "http://a.org/p", page("copy")) for at in range(40)] + [(99, "http://a.org/p", page("other"))]
    rows += [(100 + at, f"http://b.org/{at}", page("same")) for at in range(20)]
    clashing = ["text", "n_chars", "host", "path", "_host", "_path", "_html", "_hash"]
    schema = "page_id long, url string, html string, " + ", ".join(f"{name} string" for name in clashing)
    data = table([(*row, *["x"] * len(clashing)) for row in rows], schema, files=1)
    found = {r["page_id"]: r["text"] for r in html_text.extract(data.coalesce(1)).collect()}
    assert {found[at] for at in range(40)} == {"copy"} and found[99] == "other"
    assert {found[100 + at] for at in range(20)} == {"Top bar\nsame\nImprint"}


@pytest.mark.parametrize("tag", sorted(html_text.DROPPED_TAGS))
def test_unclosed_elements_end_with_their_parent(tag):
    def text(page):
        return html_text.main_lines(html_text.lines(page), None)

    inside = ["two"] if tag in html_text.FOREIGN else []
    assert text(f"<article><p>one</p><{tag}><p>two</p></article><p>three</p>") == ["one", *inside, "three"]
    assert text(f"<p>one <{tag}><b>no</b><{tag}>no</{tag}> no</{tag}> more</p><p>two</p>") == ["one more", "two"]
    assert text(f"<p>one</p></{tag}><p>two <{tag} a='b'/>more</p><{tag}>gone") == ["one", "two more"]
    assert text(f"<head><{tag}></head><body><p>one</p></body>") == ["one"]


NAMED = [
    ("<div class='social-history'><p>Text</p></div>", ["Text"]),
    ("<div id='search-results'><p>Text</p></div>", ["Text"]),
    ("<section class='related work'><p>Text</p></section>", ["Text"]),
    ("<div class='no-sidebar'><p>Text of the page</p></div><div class='sidebar'>Side</div>", ["Text of the page"]),
    ("<p>Text of some length</p><div class='share-buttons'>Share</div><div class='related'>More</div>", ["Text of some length"]),
    ("<p>Text</p><div id='comments'><p>Readers say very much more</p></div>", ["Text"]),
    ("<p>Text</p><aside><div class='share'>Very long text in a sidebar</div></aside>", ["Text"]),
    ("<article>Text</article><div class='related'>Very long text about others</div>", ["Text"]),
]


@pytest.mark.parametrize(("page", "text"), NAMED)
def test_names_of_class_and_id(page, text):
    assert html_text.main_lines(html_text.lines(page), None) == text


def test_pages_empty(table):
    assert html_text.extract(table([], "page_id long, url string, html string")).collect() == []


def test_broken_markup():
    for page in ["", "<", "<p", "a < b", "<a href='x", "<script>x", "</div></p>", "<!-- x", "<p>" * 3000, "<div>" * 3000 + "x", "&#0; &bogus; &#x110000;"]:
        html_text.lines(page)
    assert html_text.lines("<div hidden>a</div><div>b &lt;c&gt;</div>") == [("chrome", "a"), ("open", "b <c>")]


def plain_model(texts, order):
    """Chances of an interpolated modified Kneser-Ney model, from dictionaries of tuples."""
    grams = {k: Counter() for k in range(1, order + 1)}
    for tokens in texts:
        own = ["<s>", *tokens]
        grams[order].update(tuple(own[i : i + order]) for i in range(len(own) - order + 1))
        for k in range(2, order):
            if len(own) >= k:
                grams[k][tuple(own[:k])] += 1
    for k in range(order, 1, -1):
        grams[k - 1].update(gram[1:] for gram in set(grams[k]))
    words = {w for tokens in texts for w in tokens}

    def discounts(counts):
        n = [sum(c == i for c in counts.values()) for i in range(5)]
        if min(n[1:]) == 0:
            return [0, 0.5, 1, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0, *(min(max(d, 0), i) for i, d in enumerate([1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]], 1))]

    d = {k: discounts(grams[k]) for k in grams}

    def chance(context, word):
        k = len(context) + 1
        lower = chance(context[1:], word) if k > 1 else 1 / (len(words) + 1)
        same = {g: c for g, c in grams[k].items() if g[:-1] == context}
        total = sum(same.values())
        if not total:
            return lower
        left = max(same.get((*context, word), 0) - d[k][min(3, same.get((*context, word), 0))], 0)
        return (left + sum(d[k][min(3, c)] for c in same.values()) * lower) / total

    return chance


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(spark, table, order):
    draw = random.Random(order)
    texts = [" ".join(draw.choice("A b c d e") if draw.random() < 0.8 else draw.choice("fgh") for _ in range(draw.randrange(12))) for _ in range(60)]
    texts += [None, ""]
    docs = table([(i, text, None, None, None) for i, text in enumerate(texts)], DOCUMENTS)
    learned = language_model.training(F.col("doc_id"))
    model = language_model.train(docs.filter(learned), order=order, buckets=3)
    tokens = [[w.lower() for w in (text or "").split()] + ["</s>"] for text in texts]
    train = [own for i, own in enumerate(tokens) if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for own in train for w in own)
    chance = plain_model(train, order)
    for row in language_model.score(docs, model).collect():
        own = tokens[row["doc_id"]]
        seen = ["<s>", *own]
        expected = sum(math.log10(chance(tuple(seen[max(0, i - order + 1) : i]), seen[i])) for i in range(1, len(seen)))
        total, kinds = counts.total(), len(counts)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert row["score"] == pytest.approx(expected) and row["base_score"] == pytest.approx(base)
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(counts[w] > 0 for w in own))
    assert model.tokens == counts.total() and model.vocabulary == len(counts)


def test_language_model_sums_to_one(spark, table):
    words = ["a", "b", "c", "d"]
    texts = [" ".join(words[(i * j) % 4] for j in range(1, 9)) for i in range(1, 12)]
    model = language_model.train(table([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENTS), order=2, buckets=2)
    reader, known = language_model.Reader(model), language_model.Words()
    for context in ["a", "b", "zzz"]:
        each = [known.hashes(f"{context} {word}")[:2] for word in [*words, "unknown"]]
        end = np.array([known.hashes(context)[0], language_model.END], np.uint64)
        total = sum(reader.chances([own])[1] for own in [*each, end])
        assert total == pytest.approx(1.0)


def test_buckets_follow_the_texts(table, monkeypatch):
    """More text gives more buckets, not larger ones; the scores don't depend on their number, nor on maps that are let go."""
    docs = table([(i, sentence(i, 40), None, None, None) for i in range(60)], DOCUMENTS)
    model = language_model.train(docs)
    assert model.buckets == language_model.LEAST_BUCKETS
    expected = {r["doc_id"]: r["score"] for r in language_model.score(docs, model).collect()}
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 400)
    monkeypatch.setattr(language_model, "MAPPED", 3)
    model = language_model.train(docs)
    assert model.buckets == -(-sum(len(sentence(i, 40).encode()) for i in range(60)) // 400)
    assert {r["doc_id"]: r["score"] for r in language_model.score(docs, model).collect()} == expected


def test_language_model_tricky(tricky, table):
    model = language_model.train(tricky)
    rows = language_model.score(tricky, model).collect()
    assert len(rows) == len(tricky_rows()) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    empty = table([], DOCUMENTS)
    nothing = language_model.train(empty)
    assert language_model.score(empty, nothing).collect() == []
    assert {(r["score"], r["base_score"]) for r in language_model.score(tricky.limit(3), nothing).collect()} == {(0.0, 0.0)}


def test_gradients_by_differences():
    """Back-propagation against central differences."""
    net = toxicity.Network([b"a", b"b"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    draw = np.random.default_rng(1)
    x = draw.standard_normal((5, 3, 6 * toxicity.HIDDEN))
    lengths, truth, rate = np.array([5, 3, 1]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        order = np.arange(15).reshape(5, 3).T
        logit = net.logits(x.reshape(15, -1), order, lengths)
        p = toxicity.sigmoid(logit)
        return -(rate * (truth * np.log(p) + (1 - truth) * np.log(1 - p))).sum() / rate.sum()

    grads, d_x = net.gradients(x, lengths, truth, rate)
    for name, array, grad in [*((k, net.p[k], g) for k, g in grads.items()), ("x", x, d_x)]:
        for at in list(np.ndindex(array.shape))[:: max(1, array.size // 7)]:
            kept = array[at]
            array[at] = kept + 1e-4
            up = loss()
            array[at] = kept - 1e-4
            down = loss()
            array[at] = kept
            assert (up - down) / 2e-4 == pytest.approx(grad[at], abs=2e-4), (name, at)


def test_windows_cover_the_text():
    for count in [0, 1, 24, 95, 96, 97, 168, 1000, 30_000]:
        found = toxicity.windows(count)
        assert sorted({i for a, b in found for i in range(a, b)}) == list(range(count))
        assert all(b - a <= toxicity.WINDOW for a, b in found)


@pytest.fixture
def labelled(table):
    draw = random.Random(6)

    def text(toxic):
        words = [draw.choice(["stone", "river", "cloud", "field", "house", "green"]) + draw.choice(["", "s", "ing"]) for _ in range(draw.randrange(5, 160))]
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["vileword", "vilething", "vilest"]))
        return " ".join(words)

    marks = [int(i % 5 < 2) for i in range(400)]
    docs = table([(i, text(mark), "en", "a", 1) for i, mark in enumerate(marks)], DOCUMENTS)
    labels = table([(i, 1, mark) for i, mark in enumerate(marks)] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels, marks


def test_toxicity_held_out(labelled):
    docs, labels, marks = labelled
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    held = [(r["score"] >= 0.5, marks[r["doc_id"]]) for r in rows if r["out"]]
    assert {r["doc_id"] for r in rows if r["out"]} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([a == b for a, b in held]) > 0.95


def test_toxicity_tricky(labelled, tricky, table):
    _, labels, _ = labelled
    model = toxicity.learn(labelled[0], labels, sample=40, epochs=1)
    rows = toxicity.score(tricky, model).collect()
    assert len(rows) == len(tricky_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    twice = [r["score"] for r in rows if r["doc_id"] == 9]
    assert len(set(twice)) == 2
    empty = table([], DOCUMENTS)
    unlearned = toxicity.learn(empty, labels.limit(0))
    assert toxicity.score(empty, model).collect() == []
    assert {r["score"] for r in toxicity.score(tricky, unlearned).collect()} == {0.0}


def test_toxicity_score_by_plain_steps(labelled):
    """A whole score again: each word by itself, each window step by step, the two largest logits."""
    docs, labels, _ = labelled
    model = toxicity.learn(docs, labels, sample=60, epochs=2)
    p = {name: np.asarray(value, np.float64) for name, value in model.net.p.items()}

    def word(own):
        grams = [g for n in toxicity.GRAMS for g in _grams(own, n)]
        total = sum((p["gram"][g] for g in grams), np.zeros(toxicity.WIDTH))
        return np.concatenate([p["word"][model.net.ids.get(own, 0)], total / math.sqrt(max(1, len(grams)))])

    def _grams(own, n):
        marked = b"\x02" + own + b"\x03"
        for at in range(len(marked) - n + 1):
            mixed = 0
            for byte in marked[at : at + n]:
                mixed = ((mixed ^ byte) * 0x01000193) % 2**32
            yield (mixed ^ (mixed >> 15)) % toxicity.GRAM_BUCKETS

    def states(rows, weights):
        h, out, size = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for x in rows:
            g = h @ weights
            z, r = (1 / (1 + np.exp(-(x[a : a + size] + g[a : a + size]))) for a in (0, size))
            n = np.tanh(x[2 * size :] + r * g[2 * size :])
            h = (1 - z) * n + z * h
            out.append(h)
        return out

    def logit(words):
        x = [word(own) @ p["in"] + p["in_bias"] for own in words]
        half = 3 * toxicity.HIDDEN
        forward = states([row[:half] for row in x], p["forward"])
        backward = states([row[half:] for row in x][::-1], p["backward"])[::-1]
        both = [np.concatenate(pair) for pair in zip(forward, backward, strict=True)]
        weight = np.exp([np.tanh(s @ p["attend"] + p["attend_bias"]) @ p["query"] for s in both])
        return float(sum(w * s for w, s in zip(weight / weight.sum(), both, strict=True)) @ p["out"] + p["out_bias"][0])

    texts = [row["text"] for row in docs.orderBy("doc_id").limit(12).collect()] + ["a", "", "river " * 300]
    for text, score in zip(texts, model.scorer()([toxicity.tokens(text) for text in texts]), strict=True):
        words = toxicity.tokens(text)
        logits = sorted([logit(words[a:b]) for a, b in toxicity.windows(len(words))] or [p["out_bias"][0]], reverse=True)
        x = np.clip([logits[0], logits[min(1, len(logits) - 1)]], -12, 12)
        assert score == pytest.approx(1 / (1 + math.exp(-(model.weights[0] + x @ model.weights[1:]))), abs=1e-3)
