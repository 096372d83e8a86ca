from __future__ import annotations

import html
import random
import re

import duckdb
import pytest
from helpers import pages

from tidemill.llm import html_extraction as he

LONG = "This is a rather long sentence of the article, with many words in it. " * 4
P = f"<p>{LONG}</p>"
TEXT = LONG.strip()


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("  \n ", ""),
        ("just text\n here", "just text here"),
        ("<nav>only a menu</nav>", ""),
        (f"<body><nav><a href=x>A</a></nav><article><h1>T&eacute;st &amp;\n x</h1>{P}<p>short</p></article></body>", f"Tést & x\n{TEXT}\nshort"),
        (f"<article>{P}<aside>Related</aside><form>Name <input></form><p>a <button>Click</button> b</p></article>", f"{TEXT}\na b"),
        (f"<article><p>one<br>two<p>three<ul><li>x<li>y</ul>{P}</article><footer>c</footer>", f"one two\nthree\nx\ny\n{TEXT}"),
        (f"<main><header>Site</header><article><header><h1>H</h1></header>{P}</article><div>outside</div></main>", f"H\n{TEXT}"),
        (f"<article>{P}<section class='comments'><p>I agree</p></section><div id=cookie-notice>We</div></article>", TEXT),
        (f"<article>{P}<article class='comment'>{P}</article></article>", TEXT),
        (f"<div class='header'>Site</div><div id=content>{P}<p>end</p></div><div class=sidebar>{P}</div>", f"{TEXT}\nend"),
        (f"<article>{P}<script>var x='<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> --></article>", TEXT),
        (f"<article>{P}<table><tr><td>1<td>2</table></article>", f"{TEXT}\n1\n2"),
        (f"<article>{P}<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p></article>", TEXT),
        (f"<article>{P}&lt;b&gt; &#x41;&#66;&nbsp;c", f"{TEXT}\n<b> AB c"),
        (f"<article>{P}<!-- open <p>no", TEXT),
        (f"<article>{P}<p>x<![CDATA[zz]]>y</p><![if foo]>", f"{TEXT}\nxy"),
        (f"<article><p>before <label>x<div>y</div></label> after</p>{P}</article>", f"before\nafter\n{TEXT}"),
    ],
)
def test_pages(page, text):
    assert he.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article class='post has-sidebar'><h1>H</h1>{P}</article>", f"H\n{TEXT}"),
        (f"<div id=page class=with-header-menu><h1>H</h1>{P}</div>", f"H\n{TEXT}"),
        (f"<article class='entry comment-open'>{P}</article>", TEXT),
        (f"<main><div class='entry comment-open'>{P}</div></main>", TEXT),
        (f"<article><div class='article-header'><h1>H</h1></div>{P}</article>", f"H\n{TEXT}"),
        (f"<body><form id=aspnetForm><div class=menu>M</div><div><h1>H</h1>{P}</div></form></body>", f"H\n{TEXT}"),
        (f"<div class=page-menu><article>{P}</article><div class=related-posts><article>{P}</article></div></div>", TEXT),
        (f"<div id=a><div>{P * 3}</div><div><p>short part</p></div><div>{P * 3}</div></div>", "\n".join([TEXT] * 3 + ["short part"] + [TEXT] * 3)),
        (f"<div><article>{P}</article><article><p>brief</p></article><article>{P}</article></div>", f"{TEXT}\nbrief\n{TEXT}"),
        (f"<article>{P}<section class=comments>{P * 9}</section></article>", TEXT),
    ],
)
def test_names_and_regions_that_mislead(page, text):
    assert he.main_text(page) == text


def test_misleading_names_nested_deep():
    assert he.main_text("<div class=page-menu>" * 5_000 + "deep") == "deep"
    assert he.main_text("<div class=page-menu><article></article>" * 2_000 + "<article>deep") == "deep"


def test_given_pages_against_their_article():
    """The given pages mark their article; its blocks, found by patterns, must be the result."""
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inner.replace("<br>", " "))
        texts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
        assert he.main_text(page) == "\n".join(t for t in texts if t)


def test_any_markup_is_taken():
    random.seed(3)
    parts = ["<p>", "</p>", '<div class="ad">', "</div>", "<!--", "-->", "<![", "<", ">", "&", "a b", "<article>",
             "</article>", "<script>", "</script>", "<br/>", '"', "'", '<a href="', "\0", "<nav>", "</nav>", "<?x"]
    for _ in range(1500):
        he.main_text("".join(random.choice(parts) for _ in range(40)))
    assert he.main_text("<" * 20_000) is not None
    assert he.main_text("<div>" * 20_000 + "deep") == "deep"
    assert he.main_text('<a b="' * 20_000) == ""


def test_rows(spark):
    rows = [(1, "u", f"<article>{P}</article>"), (1, "u", f"<article>{P}</article>"), (2, None, None), (None, "v", "")]
    found = he.extract(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert he.extract(pages(spark, [])).count() == 0


def test_code_points_are_counted(spark):
    found = he.extract(pages(spark, [(1, "u", "<article><p>é😀</p></article>")])).first()
    assert (found["text"], found["n_chars"]) == ("é😀", 2)
