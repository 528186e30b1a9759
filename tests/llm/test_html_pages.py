"""Labelled pages: wrappers named after what stands beside the text, page-wide forms, languages without a list, and what must stay out."""

import pytest

from genomill.llm import html_text

STOP = frozenset(w for words in html_text.STOP_WORDS.values() for w in words.split())
LINE = "The report of the council says that the old bridge over the river is to be closed for a year, and that all of the traffic will have to go by the long road to the north."
TEXT, MORE = f"{LINE} {LINE}", f"{LINE} It was said in the town that they had not been asked about it at all."
BODY = f"<h1>The old bridge</h1><p>{TEXT}</p><p>{MORE}</p>"
MAIN = f"The old bridge\n{TEXT}\n{MORE}"
AROUND = '<nav><a href="/">Home</a> <a href="/n">News</a></nav><div class="sidebar"><p>Read more of the best of the week in our list of the things that you have to see and to know about this.</p></div>'
FOOT = "<footer>Copyright of the company and of all of its partners in the world, who have the right to it.</footer>"
RUSSIAN = "Совет города сообщил, что старый мост через реку будет закрыт на год, и всё движение пойдёт по длинной северной дороге. " * 4
CHINESE = "市议会报告称，河上的旧桥将关闭一年，所有交通都将改走北边的长路。" * 8
POLISH = "Rada miasta podała, że stary most przez rzekę zostanie zamknięty na rok, a cały ruch pójdzie długą drogą na północ. " * 4

KEPT = [
    '<div class="layout-sidebar-right">%s</div>', '<div id="wrapper" class="right-sidebar">%s</div>', '<div class="content-with-sidebar">%s</div>', '<div class="content-with-sidebar"><article>%s</article></div>',
    '<div class="category-social-science">%s</div>', '<form id="aspnetForm">%s</form>', '<form><div class="page-menu-left">%s</div></form>', '<div class="no-sidebar">%s</div>', "<div>%s</div>", "<main>%s</main>",
    '<article class="tags-open">%s</article>', '<div class="searchable-page"><section>%s</section></div>', '<table><tr><td>%s</td></tr></table>', '<fieldset class="frame">%s</fieldset>', "<center>%s</center>",
]


@pytest.mark.parametrize("frame", KEPT)
def test_wrappers_keep_their_page(frame):
    assert html_text.main_text(f"<html><head><title>x</title></head><body>{AROUND}{frame % BODY}{FOOT}</body></html>", STOP) == MAIN


@pytest.mark.parametrize("text", [RUSSIAN, CHINESE, POLISH])
@pytest.mark.parametrize("frame", ["<div>%s</div>", "<article>%s</article>", '<div class="sidebar-page">%s</div>'])
def test_languages_without_a_list(frame, text):
    page = f"<body><nav><a href='/'>x</a></nav>{frame % f'<p>{text}</p><p>{text}</p>'}<ul><li><a href='/a'>{text}</a></li></ul></body>"
    assert html_text.main_text(page, STOP) == f"{text.strip()}\n{text.strip()}"


@pytest.mark.parametrize(
    "extra",
    [
        f'<div class="comment-list"><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p></div>', f'<div class="widget-area"><p>{TEXT}</p></div>', f"<form><p>{TEXT}</p></form>", f'<div class="cookie-consent"><p>{TEXT}</p></div>',
        f'<div hidden><p>{TEXT}</p></div>', f"<aside><p>{TEXT}</p></aside>", f'<ul><li><a href="/x">{TEXT}</a></li></ul>', f'<div class="related-posts"><p>{MORE}</p></div>', f'<section id="top-banner"><p>{MORE}</p></section>',
    ],
)
def test_what_stands_beside_stays_out(extra):
    assert html_text.main_text(f"<body>{AROUND}<div>{BODY}</div>{extra}{FOOT}</body>", STOP) == MAIN


def test_pages_without_main_text_stay_empty():
    for page in (AROUND, AROUND + FOOT, f'<div class="comment-list"><p>{TEXT}</p></div>', f'<div class="cookie-notice"><p>{TEXT}</p></div>', "<ul><li><a href='/a'>one</a></li></ul>", "<p>Short.</p>"):
        assert html_text.main_text(f"<body>{page}</body>", STOP) == ""


def test_short_paragraphs_together():
    page = "<body>" + AROUND + "<div>" + "".join(f"<p>Verse {i} sung again.</p>" for i in range(20)) + "</div></body>"
    assert html_text.main_text(page, STOP) == "\n".join(f"Verse {i} sung again." for i in range(20))
