import re
import time

import pytest

from crossfade.llm import html_text as H

ARTICLE = "<p>One &amp; two&nbsp;three\n four</p><p>Fünf &lt;six&gt; &copy; &#x41;"
PAGES = {
    "article": f"<html><head><title>t</title><style>p{{}}</style><script>var t='</p><article>no'</script></head><body><nav><a>menu</a></nav>"
    f"<header>top</header><div class='ad box'>buy</div><article><h1>Title</h1>{ARTICLE}<div id=comments>reader</div><aside>side</aside>"
    f"<form>send</form><!-- <p>gone</p> --><p>End</p></article><footer>&copy; foot</footer></body></html>",
    "truncated": "<article><p>Left open <b>bold<br><p>next</p><p>a < b &am",
    "plain": "no markup  at all",
}


def test_scan():
    def text(page):
        return [t for k, t in H.scan(page) if k == "content"]

    assert text(PAGES["article"]) == ["Title", "One & two three four", "Fünf <six> © A", "End"]
    assert text(PAGES["truncated"]) == ["Left open bold", "next", "a < b &am"]
    assert H.scan(PAGES["plain"]) == [("open", "no markup at all")]
    assert H.scan("") == [] and H.scan("<p") == [] and H.scan("<!-- open") == []
    assert H.scan('<div style="display:none">x</div><p hidden>y</p><p>z') [-1] == ("open", "z")
    assert [k for k, _ in H.scan("<p class='headers-up'>a</p><p class='site-footer'>b</p>")] == ["open", "chrome"]


def test_end_tags_are_found_by_their_place_and_at_once():
    """Only A-Z are folded, places count code points, and a long page of other scripts takes no time per character."""
    far = "é\U0001F600" * 50
    assert H.scan(f"{far}<ASIDE>x</Aside>y") == [("open", far), ("chrome", "x"), ("open", "y")]
    assert H.scan(f"</aside>{far}<aside>x") == [("open", far), ("open", "x")]
    assert H.scan("<mar\u212a class=comment>x</MARK>y")[0][0] == "chrome"
    page = "é" * 1_000_000 + "<aside>x</aside>"

    def seconds():
        start = time.process_time()
        H.scan(page)
        return time.process_time() - start

    assert min(seconds() for _ in range(3)) < 0.15


def brute_unique(pages):
    """Open blocks of each page less the tokens in a run of LEAST that stands on another page of the host."""
    runs = {}
    streams = {}
    for number, (host, page) in enumerate(pages):
        blocks = H.scan(page)
        streams[number] = [[t for t in text.split()] for kind, text in blocks if kind == "open"]
        for kind, text in blocks:
            words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in text.split()]
            if kind != "content":
                for i in range(len(words) - H.LEAST + 1):
                    runs.setdefault((host, *words[i : i + H.LEAST]), set()).add(page)
    out = []
    for number, (host, page) in enumerate(pages):
        kept = []
        for words in streams[number]:
            low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
            gone = {i + k for i in range(len(words) - H.LEAST + 1) if len(runs[(host, *low[i : i + H.LEAST])]) > 1 for k in range(H.LEAST)}
            kept.append(" ".join(w for i, w in enumerate(words) if i not in gone))
        out.append("\n".join(k for k in kept if k))
    return out


def test_open_pages_keep_unique_runs(spark):
    notice = "This site uses small files to remember you today"
    pages = [("a.org", f"<div>{notice}</div><div>Unique text number {i} of this host, and more of it</div><div>{notice.upper()} too {i}</div>") for i in range(6)]
    pages += [("b.org", f"<div>{notice}</div><p>short</p>"), ("a.org", ""), ("a.org", "<div>" + "word " * 4000 + "</div>")]
    rows = [(i, f"http://{h}/{i}", p, "x") for i, (h, p) in enumerate(pages)]
    df = spark.createDataFrame(rows + [rows[0]] + [(None, None, None, "y")], "page_id long, url string, html string, text string")
    got = H.main_text(df).collect()
    assert len(got) == len(rows) + 2
    expected = brute_unique(pages)
    for row in got:
        assert row["text"] == ("" if row["page_id"] is None else expected[row["page_id"]])
        assert row["n_chars"] == len(row["text"])
    assert "small files" not in expected[0] and "small files" in expected[6]


def test_articles_keep_what_their_host_repeats(spark):
    page = "<article><p>the same long article text on two pages of a host</p></article><footer>the same foot on two pages of it</footer>"
    df = spark.createDataFrame([(i, f"http://h.org/{i}", page) for i in range(2)], "page_id long, url string, html string")
    got = H.main_text(df).collect()
    assert {r["text"] for r in got} == {"the same long article text on two pages of a host"}
    assert {r["n_repeated"] for r in got} == {3}
    assert H.main_text(df.limit(0)).count() == 0


def test_names_and_forms_around_an_article_lose_nothing(spark):
    body = "<article><header><h1>Title</h1></header><p>whole text</p><div class='share-buttons'>share</div></article>"
    around = ["<div class='page no-sidebar'>{}</div>", "<div class=with-sidebar>{}</div>", "<div id='header-fixed'>{}</div>", "<form>{}</form>", "<div class='widget'>{}</div>"]
    pages = [a.format(body) for a in around] + ["<form><div class='no-sidebar'>body in divs</div></form>"]
    pages += ["<div>Body in divs</div><article>a teaser</article><div>more of it</div><div class='sidebar'>side</div>"]
    df = spark.createDataFrame([(i, f"http://h{i}.org/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = [r["text"] for r in H.main_text(df).orderBy("page_id").collect()]
    assert got == ["Title\nwhole text"] * len(around) + ["body in divs", "Body in divs\na teaser\nmore of it"]
    assert [k for k, _ in H.scan("<nav><article>a</article></nav><article>b<div class=comments><article>c</article></div></article>")] == ["chrome", "content", "chrome"]


def test_phrases_and_copies_of_few_pages_stay(spark):
    phrase = "as the old saying goes it never rains but it pours"
    notice = "All rights to these texts stay with those who wrote them"
    texts = [f"Page {i} begins its own way {i * 7} and " + (phrase if i < 3 else f"goes on {i} by {i + 1} itself {i + 2}") + f" until end {i}" for i in range(40)]
    pages = [(f"http://a.org/{i}", f"<p>{t}</p><div>{notice}</div>") for i, t in enumerate(texts)]
    pages += [(f"http://a.org/{i}?print=1", f"<div><p>{t}</p></div><div class=x>{notice}</div>") for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = [r["text"] for r in H.main_text(df).orderBy("page_id").collect()]
    assert got == texts + texts


def test_short_blocks_that_a_host_repeats_go(spark):
    menu = "".join(f"<li>{x}</li>" for x in ("Home", "News", "Sports page", "Weather", "About us", "Contact"))
    texts = [f"Own text {i} of {i * 3} with {i + 5} words" for i in range(12)]
    pages = [f"<ul>{menu}</ul><p>{t}</p><a>Read on</a><p>{t[::-1]}</p><div>Back to top</div>" for t in texts]
    df = spark.createDataFrame([(i, f"http://a.org/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = [r["text"] for r in H.main_text(df).orderBy("page_id").collect()]
    assert [g.split("\n")[0] for g in got] == texts
    assert not any(x in g for g in got for x in ("Home", "Weather", "Contact", "Back"))
    blocks = [f"<ul>{menu}</ul><p>{t}</p><div>Read on</div><p>{t[::-1]}</p>" for t in texts]
    df = spark.createDataFrame([(i, f"http://a.org/{i}", p) for i, p in enumerate(blocks)], "page_id long, url string, html string")
    assert [r["text"] for r in H.main_text(df).orderBy("page_id").collect()] == [f"{t}\n{t[::-1]}" for t in texts]


def kept(page):
    return [text for kind, text in H.scan(page) if kind == "content"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article>a</article><section class=comments><article>b</article></section>", ["a"]),
        ("<div id='comments'><article class='comment'>b</article></div><article>a</article>", ["a"]),
        ("<article>a<article class='comment'>b</article>c</article>", ["a", "c"]),
        ("<article><a href=x title=Bob's>link</a><p>Two it's fine</p></article>", ["link", "Two it's fine"]),
        ('<article><a title = "a>b" href=\'c>d\'>link</a></article>', ["link"]),
        ("<nav><a>menu</a><article>a</article>", ["a"]),
        ("<article><button>send<p>a</p></article>", ["send", "a"]),
        ("<article><p class=notice>n<div>a</div></article>", ["a"]),
        ("<article><ul><li class=share>s<li>a<ul><li class=ad>x</ul>b</ul></article>", ["a", "b"]),
        ("<article><table><tr><td class=ad>x<td>a<tr><td>b</table></article>", ["a", "b"]),
        ("<article><dl><dt class=ad>x<dd>a</dl></article>", ["a"]),
        ("<head><title>t</title><body><article>a</article>", ["a"]),
        ("<title>t</title><article>a</article>", ["a"]),
        ("<article>a<!--> b<!--x--!> c</article>", ["a b c"]),
        ("<article><p>a<br>b<br/> c</p></article>", ["a b c"]),
    ],
)
def test_markup_as_people_write_it(page, text):
    assert kept(page) == text


def test_long_and_hostile_markup_ends_soon():
    for page in ("<a =" * 50_000, "<article>" + "<nav>x" * 20_000, "<a title='" + "x=" * 200_000, "<article>" + "<p>a" * 50_000, "<" * 200_000):
        H.scan(page)
    assert kept("<article>" + "<p>a b" * 50_000) == ["a b"] * 50_000
