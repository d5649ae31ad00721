import html
import random
import re

from pyspark.sql import functions as F

from tidewatch.llm import page_template as T
from tidewatch.llm import pii_crf as P

SF = "/root/testdata/sf0.01"


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in T.main_texts(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_template_text_in_the_article_is_left_out(spark):
    """A line that is once on every page of a host is its template's; one that many pages have is not."""
    page = "<html><body><nav><a>Home</a></nav><article><h1>T{0}</h1><p>Share this story</p><p>body {0} &lt;b&gt;</p>{1}<p>end {0}</p></article><footer>f</footer></body></html>"
    rows = [(k, "http://h.example/x", page.format(k, "<p>common passage</p>" if k % 3 else "")) for k in range(30)] + [(100, "http://other.example/", page.format(1, ""))]
    same = [(200 + k, "http://same.example/", page.format(5, "")) for k in range(20)]
    got = {r.page_id: r.text for r in T.main_texts(spark.createDataFrame(rows + same, "page_id long, url string, html string")).collect()}
    assert got[1] == "T1\n\nbody 1 <b>\n\ncommon passage\n\nend 1"
    assert got[3] == "T3\n\nbody 3 <b>\n\nend 3"
    assert got[100].startswith("T1\n\nShare this story")  # too few pages for a template
    assert got[200] == "T5\n\nShare this story\n\nbody 5 <b>\n\nend 5"  # nothing would be left


def test_empty_and_foreign_pages_leave_a_host_its_template(spark):
    page = "<html><body><div><p>Home of all</p></div><article><h1>T{0}</h1><p>Share this story</p><p>body {0}</p></article><p>Imprint</p></body></html>"
    for n in (10, 300):
        rows = [(k, "http://h.example/x", page.format(k)) for k in range(n)] + [(n, "http://h.example/x", None), (n + 1, "http://h.example/x", " "), (n + 2, "http://h.example/x", "<body><section>Share this story<p>other layout</p></section></body>")]
        got = {r.page_id: r.text for r in T.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
        assert got == {k: f"T{k}\n\nbody {k}" for k in range(n)} | {n: "", n + 1: "", n + 2: "Share this story\n\nother layout"}
    rows = [(k, "http://h.example/x", page.format(k) if k % 2 else "<body><section>s<p>p</p></section></body>") for k in range(40)]
    got = {r.page_id: r.text for r in T.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "T1\n\nShare this story\n\nbody 1" and got[2] == "s\n\np"  # half of the pages make no template


def test_classes_must_be_ordered_and_nested():
    p = T.Page("<p>a</p><p>b</p><p>c</p><p>d</p><p>e</p>")
    h = {t[1]: t[0] for t in p.tokens if t[1]}
    assert p.boilerplate([(1, h["a"]), (1, h["b"]), (1, h["c"])]) == {h["a"], h["b"], h["c"]}
    assert p.boilerplate([(1, h["b"]), (1, h["a"]), (1, h["c"])]) == set()
    assert p.boilerplate([(1, h["a"]), (1, h["c"]), (1, h["e"]), (2, h["b"]), (2, h["d"])]) == {h["a"], h["c"], h["e"]}


def test_markup_and_awkward_pages(spark):
    text = lambda s: T.Page(s).main_text(set())
    assert text('<article><p>a<br>b &amp; c<script>x</article></script> d<div class="comments"><p>no</p></div><p>e</article><footer>f') == "a b & c d\n\ne"
    assert text("") == "" and text("<!-- only") == "" and text("a < b") == "a < b"
    assert text("<nav>x</nav><p>only &lt;this&gt;</p>") == "only <this>"
    assert text("<article><p>x</p><aside>y</aside><form>z</form><p title='a>b'>w</p></article>rest") == "x\n\nw"
    rows = [(1, None, None), (2, "", ""), (3, "no host", "<p>x</p>"), (3, "no host", "<p>x</p>"), (4, "http://h/", "<div>" * 5000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit("clash")).withColumn("template", F.lit(1)).withColumn("__row", F.lit(1))
    assert sorted((r.page_id, r.text) for r in T.main_texts(df).collect()) == [(1, ""), (2, ""), (3, "x"), (3, "x"), (4, "deep")]
    assert T.main_texts(df.limit(0)).count() == 0


def test_class_words_mark_no_article():
    text = lambda s: T.Page(s).main_text(set())
    assert text("<div class='content-sidebar-wrap'><main><p>a</p></main></div>") == "a"
    assert text("<main class='with-sidebar'><p>a</p></main><p>b</p>") == "a"
    assert text("<article class='post has-banner'><div class='post-header'><h1>t</h1></div><p>a</p></article><p>b</p>") == "t\n\na"
    assert text("<div class='sidebar'><p>w</p><div id='banner'><article class='post'><div class='header'>t</div>a<div class='ad'>x</div></article></div></div>") == "t\n\na"
    assert text("<div class='big sidebar'><p>x</p></div><div class='sidebar'><nav>m</nav></div><p>a</p><nav><article>n</article></nav>") == "a"


def test_comments_teasers_and_adverts_are_no_article():
    text = lambda s: T.Page(s).main_text(set())
    story = "<article class='post comments-open'><h1>t</h1><p>a</p>{}<p>b</p></article>"
    assert text(story.format("") + "<div id='comments' class='comments-area'><article class='comment-body'><p>reader</p></article></div>") == "t\n\na\n\nb"
    assert text(story.format("") + "<section class='related'><article><p>teaser</p></article></section>") == "t\n\na\n\nb"
    assert text("<main>" + story.format("") + "<article class='comment'><p>reader</p></article></main>") == "t\n\na\n\nb"
    for name in ("related-posts", "social-share", "cookie-banner", "comment-list", "ad-slot", "relatedPosts", "post__comments", "newsletter_signup", "c-share-buttons", "notice", "left-sidebar"):
        for tag in ("div", "section", "ul", "p", "span", "li", "h3", "a"):
            assert text(story.format(f"<{tag} class='x {name}'>no <{tag if tag == 'span' else 'b'}>no</{tag if tag == 'span' else 'b'}> no</{tag}>")) == "t\n\na\n\nb", (name, tag)
    for name in ("share-price", "has-sidebar", "with-comments", "article-body", "post-content", "header", "post-header", "comments-open", "ad-free", "menuet", "noticeable"):
        assert text(story.format(f"<div class='{name}'>yes</div>")) == "t\n\na\n\nyes\n\nb", name
    assert text("<ul><li class='related'>no<li>yes</ul><p class='ad'>no<p>yes<div class='ad'>no</div><p class='ad'>no<div>yes</div>") == "yes\n\nyes\n\nyes"
    # an article is nowhere but in layout, or nowhere but among comments
    assert text("<div id='sidebar'><p>x</p><article><p>a</p></article></div>") == "a"
    assert text("<div><p>a</p></div><div id='comments'><article class='comment'><p>reader</p></article></div>") == "a"


def test_long_attribute_values():
    text = lambda s: T.Page(s).main_text(set())
    for quote, other in ('"\'', "'\""):
        value = "{" + "x" * 100_000 + f" <p>hidden</p> class={other}ad{other} 1 > 0 }}"
        assert text(f"<div data-props={quote}{value}{quote}>Visible</div><p>b</p>") == "Visible\n\nb"
        assert text(f"<div data-props={quote}{value}{quote} class=ad>Visible</div><p>b</p>") == "b"
        assert text(f"<p {quote}>a</p><p>b</p>") == "a\n\nb"  # never closes
        assert text(f"<p class={quote}x{quote}{quote}>a{'y' * 5000}</p><p class={quote}z{quote}>b</p>") == f"a{'y' * 5000}\n\nb"  # opens no value
        assert text(f"<p class={quote}x>a</p><p>b</p>") == "a\n\nb"


def plain(x):
    """The contract's patterns as they stand."""
    d = lambda m: re.sub("[^0-9]", "", m[0])
    o = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    o += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    o += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x) if 13 <= len(d(m)) <= 19 and P.luhn(d(m))]
    return o + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(d(m)) <= 15]


def test_base_spans_equal_the_patterns():
    r = random.Random(2)
    for _ in range(20000):
        s = "".join(r.choice("a1.@+-( )0129%_é\n") for _ in range(r.randrange(60)))
        assert P.base_spans(s) == plain(s)


def test_model_adds_spans_and_keeps_base(spark, clashing, empty, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    crf = P.fit(docs)
    for r in docs.join(P.spans(docs, crf), "doc_id").collect():
        base, every = [tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]
        assert base == plain(r.text) and set(base) <= set(every)
        assert every == sorted(every, key=lambda s: (P.KINDS.index(s[0]), s[1]))
    find = lambda s: [(k, s[a:b]) for k, a, b in P.find(s, crf)[1]]
    assert find("call (988) 555-2485 now") == [("phone", "(988) 555-2485")]
    assert find("mail joe.x (at) mail.example.com please") == [("email", "joe.x (at) mail.example.com")]
    assert find("ring +1 (269) 555-3296 4524132264652876 and") == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    assert find("on 2024-01-02 at 12:30:11, version 1.2.3, CC BY-NC 4.0.") == []
    got = {r.doc_id: (r["base"], r["spans"]) for r in P.spans(clashing, crf).collect()}
    assert got[-1] == got[-2] == got[-3] == ([], [])
    assert P.spans(empty, crf).count() == 0 and P.fit(empty) is None
    red = P.redact(clashing, crf)
    assert red.columns == clashing.columns and red.count() == clashing.count()
    assert P.redact_text("a +44 20 7946 0958 b", [("phone", 2, 18)]) == "a [PHONE] b" and P.redact_text(None, []) is None


def test_regions_cut_no_word():
    r = random.Random(5)
    for _ in range(3000):
        s = "".join(r.choice("ab.@1() \n-") * r.choice((1, 1, 30)) for _ in range(r.randrange(40)))
        got = list(P.regions(s))
        assert all(x[1] < y[0] for x, y in zip(got, got[1:]))
        for a, b in got:
            assert (a == 0 or s[a - 1].isspace() or s[a].isspace()) and (b == len(s) or s[b].isspace() or s[b - 1].isspace())
        assert all(any(a <= m.start() and m.end() <= b for a, b in got) for m in P._TRIGGER.finditer(s))


def test_long_addresses_are_found_whole(spark):
    crf = P.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    find = lambda s: [(k, s[a:b]) for k, a, b in P.find(s, crf)[1]]
    local, host = "maria.magdalena.rodriguez-hernandez.lopez", "mathematics.uni-heidelberg-university.example.de"
    for at in (" (at) ", "(at)", " [at] ", "[at]"):
        assert find(f"please write to {local}{at}{host} today") == [("email", f"{local}{at}{host}")]
        assert find(f"{local}{at}example.com") == [("email", f"{local}{at}example.com")]
        assert find(f"or joe{at}{host}.") == [("email", f"joe{at}{host}")]
        assert find(f"mail {'x' * 90}{at}{'y' * 90}.org") == [("email", f"{'x' * 90}{at}{'y' * 90}.org")]


def test_sample_has_all_kinds(spark):
    """Numbers that are no personal data crowd none of it out, and a kind without any match is learnt all the same."""
    forms = {"call (988) 555-2485 now": [("phone", "(988) 555-2485")], "mail joe.x (at) mail.example.com please": [("email", "joe.x (at) mail.example.com")],
             "card 4524.1322.6465.2876 ok": [("card", "4524.1322.6465.2876")], "on 2024-01-02 at 12:30:11, version 1.2.3": []}
    numbers = [(k, f"on 2024-01-{k % 28 + 1:02} at 12:{k % 60:02}:11 paid {k}.50 for version 1.{k}") for k in range(3000)]
    rare = [(3000, "write to jane.roe@mail.example.com today"), (3001, "from 10.20.30.40 on")]
    for rows in (numbers + rare, numbers, [(1, "no number here")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        crf = P.fit(docs)
        for s, want in forms.items():
            assert [(k, s[a:b]) for k, a, b in P.find(s, crf)[1]] == want
    src = spark.createDataFrame([(k, t) for k, t in numbers + rare], "h long, __text string")
    ids = P.sample_ids(src, 10)
    assert {3000, 3001} < set(ids) and len(set(ids)) == len(ids) == 10
    assert all(P.base_spans(P.made_up(kind, random.Random(k)))[0][0] == kind for kind in P.KINDS for k in range(50) if kind != "phone")


def test_likelihood_gradient_fits_training_examples():
    r = random.Random(4)
    text = "see 10.0.0.1 or bob.3@mail.example.com or +1 (269) 555-3296 ok"
    examples = P.examples_of(text, r) * 10
    crf = P.train(examples, epochs=20)
    for lat, true in examples:
        assert {(s, e): k for k, s, e in crf.decode(lat)} == {lat.spans[k]: P.KINDS[y - 1] for k, y in true.items()}


def segmentations(lat, scores, moves, at=0, before=0):
    """Every segmentation from a token on, as (score, segments with their kinds)."""
    if at == lat.n:
        yield 0.0, ()
        return
    for k, (a, e) in enumerate(lat.segments):
        if a == at:
            for y in range(len(P.KINDS) + 1):
                if scores[k, y] > float("-inf"):
                    for rest, path in segmentations(lat, scores, moves, e, y):
                        yield scores[k, y] + moves[before, y] + rest, ((k, y), *path)


def test_decoding_and_likelihood_equal_enumeration(spark):
    import numpy as np

    crf = P.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    r = np.random.default_rng(1)
    for line in ("on 555 123 4567", "1.2.3.4", "a1 (at) b.c", "x 12-34 56", "a@b 7", "+1 23 4567"):
        lat = P.lattice(line, 0, len(line))
        for noise in (0.0, 2.0):
            model = P.SemiCrf(crf.index, crf.weights + noise * r.normal(size=crf.weights.shape), crf.moves + noise * r.normal(size=crf.moves.shape))
            s = model.scores(lat)
            every = list(segmentations(lat, s, model.moves))
            best = max(every, key=lambda x: x[0])
            assert model.decode(lat) == [(P.KINDS[y - 1], *lat.spans[k]) for k, y in best[1] if y]
            total = P._logsum(P.forward(lat, s, P.ends(lat), model.moves)[lat.n], 0)
            assert abs(float(total) - np.logaddexp.reduce([x for x, _ in every])) < 1e-6


def test_pieces_decode_as_the_whole(spark):
    crf = P.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    r = random.Random(8)
    for _ in range(60):
        lines = [f"call {r.randint(200, 999)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}", f"on {r.randint(1, 28)}.{r.randint(1, 12)}.2020", "joe (at) mail.example.com", "no number", P.counterexample(r)]
        r.shuffle(lines)
        text = r.choice(["\n", "   ", "\n\n"]).join(lines)
        if not P.base_spans(text):
            whole = [x for x in crf.decode(P.lattice(text, 0, len(text))) if P.holds(x[0], text[x[1]:x[2]])]
            assert sorted(whole) == sorted(P.find(text, crf)[1])


def test_added_spans_are_precise_and_complete(spark):
    """Numbers and addresses that the training hasn't seen, in forms that the patterns don't know, and numbers that are no personal data."""
    crf = P.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    r = random.Random(99)
    right = wrong = missed = 0
    for k in range(1200):
        if k % 2:
            kind = P.KINDS[k // 2 % 4]
            line = P.made_up(kind, r)
            a, e = next(x[1:] for x in P.base_spans(line) if x[0] == kind)
            new = P.rewritten(kind, line[a:e], r)
            if new is None:
                continue
            line, want = line[:a] + new + line[e:], {(kind, a, a + len(new))}
        else:
            line, want = f"see {P.counterexample(r)} for it", set()
        base, every = P.find(line, crf)
        if not base:
            right, wrong, missed = right + len(set(every) & want), wrong + len(set(every) - want), missed + len(want - set(every))
    assert right / (right + wrong) >= 0.9 and right / (right + missed) >= 0.9
    found = lambda s: [(k, s[a:e]) for k, a, e in P.find(s, crf)[1]]
    assert found("at 40.7128 74.0060 north") == found("host 192.168.1.300 down") == found("card 4111 1111 1111 1112 no") == []
    assert found("call 1-800-555-1234 now") == [("phone", "1-800-555-1234")]


def test_many_spans_take_linear_time(spark):
    import time

    crf = P.fit(spark.read.parquet(f"{SF}/documents.parquet").limit(200))
    seconds = []
    for n in (3000, 12000):
        text = " ".join(f"user{i}.name@mail{i % 97}.example.com" for i in range(n))
        t = time.time()
        assert len(P.find(text, crf)[0]) == n
        seconds.append(time.time() - t)
    assert seconds[1] < 2 and seconds[1] < 12 * max(seconds[0], 0.02)
