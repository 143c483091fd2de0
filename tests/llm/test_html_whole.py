"""Pages whose article is in several places, or in wrappers that look like noise."""

import time

import pytest

from logvigil.llm.html_text import main_text

LINES = [f"Paragraph {k} has a good number of words that say something of weight here." for k in range(10)]
ONE, TWO = ("".join(f"<p>{x}</p>" for x in part) for part in (LINES[:5], LINES[5:]))
MENU = "<nav><a href=x>Menu</a></nav><div class=sidebar><p>Aside text</p></div>"
LINKS = "<div><a href=a>One link</a> <a href=b>Two links</a></div>"


@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_blocks_side_by_side_are_all_kept(tag):
    page = f"<body>{MENU}<{tag}>{ONE}</{tag}>{LINKS}<{tag}>{TWO}</{tag}><footer>f</footer></body>"
    assert main_text(page).split("\n") == LINES


def test_a_heading_and_a_lead_beside_the_text_are_kept():
    page = f"<body>{MENU}<h1>A title</h1><p>A short lead.</p><div>{ONE}</div>{LINKS}<div>{TWO}</div></body>"
    assert main_text(page).split("\n") == ["A title", "A short lead.", *LINES]


@pytest.mark.parametrize(
    "wrapper", ["form id=aspnetForm", "div class='content-with-sidebar'", "div id=sidebar-right", "div class=social-science", "div class='page-widget-area'", "div role=form"]
)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrappers_with_names_of_noise_keep_the_article(wrapper, tag):
    end = wrapper.split()[0]
    page = f"<body><{wrapper}>{MENU}<{tag}>{ONE}{TWO}</{tag}><div class=comments>A comment</div><form>Search</form></{end}></body>"
    assert main_text(page).split("\n") == LINES


def test_noise_beside_the_article_is_left_out():
    cards = "".join(f"<article><p>{x}</p></article>" for x in LINES[5:7])
    page = f"<body><form><article>{ONE}<form>Reply <input></form></article></form><div class=related>{cards}</div></body>"
    assert main_text(page).split("\n") == LINES[:5]
    comments = f"<div class=comments>{TWO * 9}</div>"
    assert main_text(f"<body><article>{ONE}</article>{comments}</body>").split("\n") == LINES[:5]


@pytest.mark.parametrize(
    "part",
    ["<a", '"', "'", '<a x="', "<a x='", "<!--", "<!", "<", "</", "</a", "<<a", "<b>", "<b></i>", "<a x=1 y=\"2\" ", "<p><b>", "<script></script ", '<img "', "&", "<li><ul>", "<td>"],
)
def test_a_megabyte_of_broken_markup_takes_little_time(part):
    page = f"<body><p>Text before.</p>{part * ((1 << 20) // len(part))}"
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 20  # the slowest take seconds on a slow machine; minutes and more before


def test_a_tag_that_was_cut_off_ends_at_the_next_one():
    quotes = " ".join(f'a{i}="{i}' for i in range(40))
    for broken in ("<img src=x", '<a href="x', f"<img {quotes}", "<a", "</div", "<!-- open"):
        page = f"<body><article>{ONE}{TWO}</article>{broken}"
        assert main_text(page).split("\n")[: len(LINES)] == LINES
    assert main_text(f"<body><article><img alt='x' {ONE}{TWO}</article></body>").split("\n") == LINES
    assert main_text(f"<body><article><p title='a > b < c'>First.</p>{ONE}</article></body>").split("\n") == ["First.", *LINES[:5]]


def test_lists_quotes_code_and_tables_beside_the_text_are_kept():
    beside = "<ul><li>point</li></ul><blockquote>quoted</blockquote><pre>code</pre><table><tr><td>cell</td></tr></table>"
    page = f"<body>{MENU}<div>{ONE}{TWO}</div>{beside}<ul><li><a href=x>a menu of links</a></li></ul></body>"
    assert main_text(page).split("\n") == [*LINES, "point", "quoted", "code", "cell"]


def test_names_inside_an_article_are_noise_only_as_a_whole():
    kept = "<p class=search-results>Results.</p><section class=notice-of-motion><p>Motion.</p></section><p>So <math><mi>x</mi></math> holds.</p>"
    gone = "<div class=comment-list>c</div><div class='ad-slot'>a</div><div class=share-buttons>s</div><div class=related>r</div>"
    page = f"<body><article>{ONE}{kept}{gone}</article></body>"
    assert main_text(page).split("\n") == [*LINES[:5], "Results.", "Motion.", "So x holds."]
