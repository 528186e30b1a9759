"""HTML main text by two-pass block rules: stop-word density, length and link density first, then the nearest decided neighbours."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genomill.llm.common import prepare, slices, table

# Frequent function words of English, French, German, Spanish, Italian, Portuguese, Dutch.
STOP_WORDS = {
    "en": "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two him see could no make than been who its now people my made over did down only way find use may water long little very after called just where most know",
    "fr": "le la les de des du un une et est en que qui dans pour pas au aux par sur avec ce se ne plus son sa ses il elle ils nous vous je on mais ou où cette ces comme été être sont fait leur y",
    "de": "der die das und ist in den von zu mit sich auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man",
    "es": "el la los las de del que y a en un una ser se no por con para su como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos",
    "it": "il lo la i gli le di a da in con su per tra fra un una e che non si come anche più ma ha sono del della dei delle al alla nel nella",
    "pt": "o a os as de do da dos das em um uma e que não se por com para como mais mas foi ao ele ela seu sua no na nos nas",
    "nl": "de het een en van in is dat op te zijn voor met die niet aan er om ook als maar bij of uit nog naar dan door over",
}
# Elements whose content is never main text.
DROPPED = frozenset("head script style noscript template iframe object embed svg math canvas audio video map nav header footer aside form button select textarea input label fieldset dialog menu title".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe"])
# Elements that begin and end a block.
BLOCKS = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id or role that mark what is not main text.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr header menu menubar masthead modal nav navbar navigation navigationbar newsletter notice notices pagination pager paywall popup promo promotion promoted related recommended respond share sharing shoutbox sidebar sidenav skyscraper social sponsor sponsored subscribe subscription tags toolbar topbar widget alert alerts complementary contentinfo search signup login".split()
)
#: Elements and marks in a part of a name may also hold a whole page (a form around everything, a layout-with-sidebar): they don't count if nothing else is left.
SOFT = frozenset(["form", "fieldset"])
#: Marks that never name a whole page, not even as a part of a name.
NEVER = frozenset("ad ads adv advert adverts advertisement advertising comment comments commentlist consent cookie cookies disqus gdpr modal newsletter popup".split())
#: Marks that count outside of articles alone where they are only a part of a name: an entry-header or search-intro of an article is text.
WEAK = frozenset("header menu search tags banner notice notices alert alerts login signup copyright widget complementary respond recommended".split())
# A quoted value ends at its quote; one with a ">" inside must end before a blank, "/" or ">", else its quote was never closed and counts as a plain character.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\">]*+\"|'[^'>]*+'|\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PARTS = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """A run of text between block elements; `inside`: number of the article or main element that holds it (0: none)."""

    tag: str = ""
    inside: int = 0
    heading: bool = False
    dropped: bool = False
    soft: tuple[int, ...] = ()
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None


def _marked(attributes: str, inside: bool) -> int:
    """Whether class, id or role names what is not main text (2: as a whole, 1: by a part of a name), or the element is hidden (2)."""
    found = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
        if name in ("class", "id", "role"):
            for own in value.split():
                if own in MARKED:
                    return 2
                if not own.startswith(("no-", "with-", "has-", "without-")) and (parts := (MARKED - WEAK if inside else MARKED).intersection(_PARTS.findall(own))):
                    if parts & NEVER:
                        return 2
                    found = 1
    return found


def blocks_of(page: str, lifted: frozenset[int] = frozenset()) -> list[Block]:
    """Blocks in page order. Unclosed and stray tags are allowed for; what is dropped by its element or mark is flagged.

    `soft` of a block: numbers of the elements around it that a part of a name or a form drops, if no other element drops it too. Those of `lifted` don't drop.
    """
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # tag, drops, number of the innermost article
    softs: list[int] = []  # for each element on the stack the number of its soft mark, 0: none
    numbers = 0
    opened: Counter[str] = Counter()  # of the tags on the stack
    drops = links = articles = at = 0
    block = Block()

    def pop(depth: int) -> list[tuple[str, bool, int]]:
        """Everything from that depth on ends."""
        nonlocal drops, links
        gone = stack[depth:]
        del stack[depth:], softs[depth:]
        opened.subtract(t for t, _, _ in gone)
        drops -= sum(d for _, d, _ in gone)
        links -= sum(t == "a" for t, _, _ in gone)
        return gone

    def close() -> None:
        nonlocal block
        if block.parts:
            found.append(block)
        last = stack[-3:]
        block = Block(tag=last[-1][0] if last else "", inside=last[-1][2] if last else 0, heading=any(re.fullmatch("h[1-6]", t) for t, _, _ in last), dropped=drops > 0, soft=tuple(filter(None, softs)) if drops == sum(map(bool, softs)) else ())

    def add(text: str) -> None:
        if text:
            text = html.unescape(text)
            block.parts.append(text)
            if links:
                block.linked += len("".join(text.split()))

    while m := _TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br":
            block.parts.append("\n")
        elif closing:
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag) if opened[tag] else None
            if depth is not None and not (tag not in BLOCKS and any(t in BLOCKS for t, _, _ in stack[depth + 1 :])):
                if any(t in BLOCKS or d for t, d, _ in pop(depth)):
                    close()
            elif tag in BLOCKS:
                close()
            elif depth is not None:  # an inline end tag after unclosed blocks: only that element ends
                _, d, _ = stack.pop(depth)
                softs.pop(depth)
                opened[tag] -= 1
                drops, links = drops - d, links - (tag == "a")
        elif tag in VOID:
            if tag == "hr":
                close()
        else:
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or tag in BLOCKS:  # a block ends an open paragraph; a list item or cell its neighbour
                same = {"p"} | ({"li"} if tag == "li" else {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {"tr", "td", "th"} if tag == "tr" else set())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in same:
                        pop(i)
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if tag == "body":  # the head ends here, closed or not
                pop(0)
            main = tag in ("article", "main") and not drops
            articles += main
            inside = articles if main else stack[-1][2] if stack else 0
            mark = 0 if tag in ("html", "body", "article", "main") else _marked(m[3], inside > 0)
            hard = tag in DROPPED and tag not in SOFT and not (tag == "header" and inside) or mark == 2
            soft = not hard and (tag in SOFT or mark == 1)
            numbers += soft
            dropped = hard or soft and numbers not in lifted
            stack.append((tag, dropped, inside))
            softs.append(numbers if soft and dropped else 0)
            opened[tag] += 1
            drops += dropped
            links += tag == "a"
            if tag in BLOCKS or dropped:
                close()
    add(page[at:])
    close()
    out = []
    for b in found:
        b.text = " ".join("".join(b.parts).split())
        if b.text:
            out.append(b)
    return out


def classify(blocks: list[Block], stop: frozenset[str], low: float = 0.2, high: float = 0.3, short: int = 70, long: int = 200, link: float = 0.4, plain: bool = False) -> list[Block]:
    """Sets `good`. First pass: dropped or link-heavy blocks are bad; long ones with stop words good, without bad; the rest is open.

    Where article or main elements hold most of the good text, all outside is bad; else they count for nothing (teasers). Second pass: an open block takes the label of its nearest decided neighbours within its own article (or outside of any);
    where they differ, the good one counts inside an article, the bad one outside. An article without a decided block is good.
    `plain`: for pages of a language without a list, long blocks are good by length; if there is none, paragraphs that are long together.
    """
    for b in blocks:
        size, b.good = len(b.text), None
        if b.dropped or b.linked > link * len("".join(b.text.split())):
            b.good = False
        elif plain:
            b.good = True if size >= long else None
        else:
            words = _WORD.findall(b.text.lower())
            density = sum(w in stop for w in words) / max(1, len(words))
            if size >= long and density >= high or size >= short and density >= low:
                b.good = True
            elif size >= long and density < low / 2:
                b.good = None if b.inside else False
    if plain and not any(b.good for b in blocks):
        paragraphs = [b for b in blocks if b.good is None and b.tag == "p"]
        if sum(len(b.text) for b in paragraphs) >= long:
            for b in paragraphs:
                b.good = True
    inside, outside = (sum(len(b.text) for b in blocks if b.good and bool(b.inside) == x) for x in (True, False))
    if any(b.inside and not b.dropped for b in blocks):
        for b in blocks:
            if inside < outside:
                b.inside = 0
            elif not b.inside:
                b.good = False
    live = [b for b in blocks if not b.dropped]
    n = len(live)
    before: list[bool | None] = [None] * n
    after: list[bool | None] = [None] * n
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        last, where = None, None
        for i in order:
            if live[i].inside != where:
                last, where = None, live[i].inside
            out[i] = last
            if live[i].good is not None:
                last = live[i].good
    for b, x, y in zip(live, before, after, strict=True):
        if b.good is None:
            near = {x, y} - {None}
            b.good = bool(b.inside) if not near else (True in near if b.inside else near == {True})
    return blocks


def _wrappers(blocks: list[Block]) -> frozenset[int]:
    """Soft marks of elements that hold over half of the text that nothing else drops."""
    held: Counter[int] = Counter()
    free = 0
    for b in blocks:
        if not b.dropped or b.soft:
            free += len(b.text)
            held.update(dict.fromkeys(b.soft, len(b.text)))
    return frozenset(n for n, size in held.items() if 2 * size > free)


def main_text(page: str | None, stop: frozenset[str]) -> str:
    """The good blocks. Where none is good, soft marks of elements that hold most of the page are lifted; then length alone decides."""
    if not page:
        return ""
    blocks = classify(blocks_of(page), stop)
    if not any(b.good for b in blocks):
        lifted = _wrappers(blocks)
        for marks, plain in ((lifted, False), (frozenset(), True), (lifted, True)):
            if plain or marks:
                blocks = classify(blocks_of(page, marks), stop, plain=plain)
            if any(b.good for b in blocks):
                break
    return "\n".join(b.text for b in blocks if b.good)


def extract_text(pages: DataFrame, stop_words: dict[str, str] | None = None) -> DataFrame:
    """`pages` with `text`, the main text of the whole `html` (null or without main text: empty), and `n_chars`, its code points.

    Blocks are joined in page order by one line feed; white space inside a block is one blank; character references are
    decoded. Where article or main elements hold most of the running text, only what they hold can be main text. A page that would
    come out empty is looked at again: forms and marks in a part of a name don't count if they hold most of it, and length alone decides. Null ids or urls, repeated
    rows: each row by itself. Columns text and n_chars of `pages` are replaced, all others pass through, html does not.
    """
    prepare(pages.sparkSession)
    stop = frozenset(w for words in (stop_words or STOP_WORDS).values() for w in words.split())
    pages = pages.select(*[c for c in pages.columns if c not in ("text", "n_chars", "html")], F.col("html").cast("string").alias("html"))
    schema = pages.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x, stop) for x in batch.column("html").to_pylist()]
            rest = batch.drop_columns(["html"])
            yield rest.append_column("text", pa.array(texts, pa.string())).append_column("n_chars", pa.array(map(len, texts), pa.int64()))

    return pages.mapInArrow(run, schema)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
