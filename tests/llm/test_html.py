import random

from hitroll.llm import html_extract as H
from tests.llm.edge import save

SCHEMA = "page_id long, url string, html string, text string, host int"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def is_subsequence(part, whole):
    it = iter(whole)
    return all(x in it for x in part)


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(14)
    for limit in (1 << 28, 6):
        monkeypatch.setattr(H, "MAX_TABLE", limit)
        for _ in range(500):
            a = [rng.randint(0, 4) for _ in range(rng.randint(0, 14))]
            b = [rng.randint(0, 4) for _ in range(rng.randint(0, 14))]
            places = H.shared_lines(a, b)
            assert places == sorted(set(places)) and len(places) == lcs(a, b)
            assert is_subsequence([a[k] for k in places], b)


def text(page):
    return H.main_text(H.page_lines(page), [])


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{x:y}</style></head><body class="with-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav>
    <div class="cookie-notice">We use <b>cookies</b><div>inner</div></div><!-- a <p>hidden</p> -->
    <article class="post"><header class="entry-header"><h1>Ti&amp;tle &lt;x&gt;</h1></header>
    <p>One  <b>bold</b>\n text&nbsp;here<br>next<p>Two<script>var a="</p>";</script> more
    <div class="ad">Buy</div><ul><li>i1<li>i2</ul><form><p>Mail</p></form>
    <table><tr><td>c1<td>c2</table>
    <section id="comments"><article><p>First!</p></article></section></article>
    <aside><article><p>teaser</p></article></aside><footer>&copy; x</footer></body></html>"""
    assert text(page).split("\n\n") == [
        "Ti&tle <x>", "One bold text here next", "Two more", "i1", "i2", "c1", "c2"]
    assert text("<p>a < b <i>c</i>d</p>tail") == "a < b cd\n\ntail"
    assert text("<article><p>cut off <b>he") == "cut off he"
    assert text("") == text("<nav>x") == text("<script>x") == ""
    assert text('<p>x<span class="ad">buy <span>now</span></span> y</p>') == "x\n\ny"


def test_template_lines_go_by_differencing(spark, tmp_path):
    def page(k):
        return (f"<div>Our site</div><p>story {k} one</p><div>Like us</div><p>story {k} two</p>"
                "<div>Imprint</div>")
    rows = [(k, f"https://a.example/news/{k}.html?x#y", page(k), "t", 1) for k in range(20)]
    rows += [(100, "https://b.example/only", page(100), "t", 1), (101, None, page(101), "t", 1),
             (102, "no url", page(102), "t", 1), (103, "https://c.example/e", None, "t", 1),
             (104, "https://d.example/1", page(7), "t", 1), (105, "https://d.example/2", page(7), "t", 1),
             (106, "https://d.example/3", page(8), "t", 1), (107, "https://d.example/3", page(8), "t", 1),
             (108, "https://e.example/1", "<article>same</article>", "t", 1),
             (109, "https://e.example/2", "<article>same</article>", "t", 1),
             (110, "https://f.example/x", "<p>" + "w " * 300000 + "</p>" * 3, "t", 1)]
    folder = save(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.page_id: r for r in H.op6_html_extraction(spark, folder).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(rows)
    for k in range(20):
        assert got[k].text == f"story {k} one\n\nstory {k} two" and got[k].n_chars == len(got[k].text)
        assert got[k].url == rows[k][1]
    for k in (100, 101, 102):
        assert got[k].text.startswith("Our site\n\nstory")
    assert got[103].text == "" and got[103].n_chars == 0
    assert got[105].text == "story 7 one\n\nstory 7 two"     # 104 is a copy, 106 is not
    assert got[108].text == got[109].text == "same"
    assert got[110].n_chars == 599999


def test_empty_table(spark, tmp_path):
    folder = save(spark.createDataFrame([], SCHEMA), tmp_path, "pages")
    assert H.op6_html_extraction(spark, folder).collect() == []


def differenced(spark, folder, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        return {r.page_id: r.text for r in H.op6_html_extraction(spark, folder).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_neighbours_across_partition_borders(spark, tmp_path):
    def page(k):
        return f"<div>Our site</div><p>story {k} one</p><p>story {k} two</p><div>Imprint</div>"
    rows = [(k, f"https://h{k // 2:02}.example/{k}", page(k), "t", 1) for k in range(14)]
    rows += [(k, f"https://long.example/{k}", page(50 if 30 < k < 50 else k), "t", 1)
             for k in range(20, 60)]                       # a run of 19 copies over many parts
    folder = save(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    for partitions in (1, 3, 30):
        got = differenced(spark, folder, partitions)
        for k, _, _, _, _ in rows:
            story = 50 if 30 < k < 50 else k
            assert got[k] == f"story {story} one\n\nstory {story} two", (partitions, k)


def test_copies_are_told_without_the_template(spark, tmp_path):
    menu = "".join(f"<div>menu {k}</div>" for k in range(30))
    short = lambda k: f"{menu}<p>story {k} one</p><p>story {k} two</p>"
    long = lambda k, own: (menu + "".join(f"<p>part {j} of {k}</p>" for j in range(20))
                           + f"<p>only in {own}</p>")
    rows = [(k, f"https://a.example/{k:03}", short(k), "t", 1) for k in range(40)]
    rows += [(k, f"https://a.example/{k:03}", long("x", k), "t", 1) for k in range(40, 48)]
    rows += [(k, f"https://a.example/{k:03}", short(k), "t", 1) for k in range(48, 60)]
    folder = save(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    for partitions in (1, 7):
        got = differenced(spark, folder, partitions)
        for k in range(60):
            if 40 <= k < 48:                               # near copies of a long article
                story = [f"part {j} of x" for j in range(20)] + [f"only in {k}"]
            else:
                story = [f"story {k} one", f"story {k} two"]
            assert got[k].split("\n\n") == story, (partitions, k)


def test_differencing_acts_inside_articles(spark, tmp_path):
    def page(k):
        return f"<article><p>Read this offline</p><p>story {k}</p><p>series {k // 2}</p></article>"
    rows = [(k, f"https://a.example/{k:02}", page(k), "t", 1) for k in range(8)]
    rows += [(20 + k, f"https://two.example/{k}", page(k), "t", 1) for k in range(2)]
    folder = save(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    for partitions in (1, 5):
        got = differenced(spark, folder, partitions)
        for k in range(8):                                 # shared by two neighbours alone: stays
            assert got[k].split("\n\n") == [f"story {k}", f"series {k // 2}"]
        for k in range(2):                                 # two pages do not make a template
            assert got[20 + k].split("\n\n") == ["Read this offline", f"story {k}", "series 0"]


def test_unended_markup_is_read_once():
    """Texts of megabytes that took a time in the square of their length."""
    assert H.page_lines("<a " * 700_000)[0][0].startswith("<a <a ")
    assert H.page_lines("<a " * 700_000 + ">") == []
    assert H.page_lines("<script " * 300_000) != []
    deep = H.page_lines("<div>" * 200_000 + "<a>x</a>" * 200_000 + "</b>" * 200_000)
    assert deep == [("x" * 200_000, False, False)]


def test_what_begins_behind_the_last_tag_end():
    assert H.page_lines("<p>a</p>b < c <!-- d") == [("a", False, False), ("b < c", False, False)]
    assert H.page_lines("<p>a<script>b < c") == [("a", False, False)]
    assert H.page_lines("<p>a<!-- b > c <i") == [("a", False, False)]


def test_lines_are_packed_for_the_shuffle():
    page = ("<nav>menu</nav><p>one &amp; \x1c \x85 two</p><article><p>ünï \U0001f600 0</p><aside>1x</aside>"
            "</article>" + "<p>words in a long row of text</p>" * 50)
    lines = H.page_lines(page)
    assert {(a, c) for _, a, c in lines} == {(True, False), (False, False), (False, True), (True, True)}
    assert H.unpacked(H.packed(lines)) == lines and H.unpacked(H.packed([])) == []
    assert len(H.packed(lines)) < sum(len(t) for t, _, _ in lines) / 3
