"""Main text of web pages by two-pass block rules.

A page becomes blocks of text: every block-level tag ends one.  The first pass classifies
blocks by length, link density and stop-word density as good, near-good, bad or short.
In the second pass near-good and short blocks inherit the label of the nearest decided
neighbour; near-good ones go first.  A heading above something good is good.

Distances are measured along the page: a block is one step, and leaving or entering a
container (div, section, list, ...) is as far as CROSSING blocks, so a short paragraph
belongs to its siblings rather than to the footer after them.

What a page says about itself gives labels to start from, never results:

* Blocks in nav, footer, aside and like elements, in headers outside an article, in forms,
  and in containers whose class or id is made of words for menus, adverts, notices,
  comments and the like are bad neighbours.  A name counts only if all of its parts are
  such words (``ad-box``, not ``market-share``), and not beside a word for the article
  (``post comments``).  A form that holds a good block is a wrapper and counts for nothing,
  and if nothing of a page is left, names count for nothing.
* The edges of an article or main element are good neighbours, and a block inside one that
  has too few stop words for a language known here is near-good instead of bad.

Character references are decoded, white space becomes one space, and good blocks are
joined by a blank line in page order.

Edge cases: a null page is an empty one; a page cut anywhere is read as far as it goes; no
good block gives the empty string; ties of distance go to the earlier neighbour; repeated
rows give equal texts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm import common

# Elements whose text is never shown.
HIDDEN = set("script style noscript template iframe object svg canvas head title select option button textarea datalist xmp".split())
RAW = set("script style textarea title noscript iframe template xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
# Elements and roles that stand beside an article.
BESIDE = set("nav footer aside dialog menu".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
CONTAINERS = set("address article aside blockquote body center details dialog div dl fieldset figure footer form header li main menu nav ol section table tbody td tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Words of class names and ids for what stands beside an article, words that
# say nothing next to those, and words for the article itself.
MARKERS = set(
    "ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription paywall share sharing social "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar footer header masthead comment comments commentlist respond replies reply disqus related recommended widget widgets toolbar login signup".split()
)
NEUTRAL = set("site page global top bottom left right primary secondary main inner outer list item items box bar area block section container wrapper wrap row links link buttons button message posts stories side and the".split())
ARTICLE_WORDS = set("article articles post entry content story text body hentry".split())
STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be because been but by can could do for from had has have he her his how i if in into is it its just like more my no not of on one only or other our out over she so some than that the their them then there these they this time to up was we were what when which who will with would you your "
    # German
    "aber als am auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer er es für hat haben ich ihr im in ist ja kann mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn wie wir wird zu zum zur "
    # French
    "au aux avec ce ces cette comme dans de des du elle en est et être eux il ils je la le les leur lui mais me même mon ne nous on ou où par pas plus pour qu que qui sa sans se ses son sont sur ta te tu un une vous y à "
    # Spanish
    "al como con cuando de del desde donde el ella en entre era es esta este está fue ha hay la las le les lo los más me mi muy ni no nos o para pero por porque que se sin sobre son su sus también te tiene un una uno y ya".split()
)

#: Characters of a short block, and of a block that is good by itself.
SHORT, LONG = 70, 200
MOST_LINKS = 0.5
#: Stop words among words: fewer are bad, more are good in a long block.
STOP_LOW, STOP_HIGH = 0.06, 0.2
#: Blocks that the border of a container counts for.
CROSSING = 4

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
WORDS = re.compile(r"[^\W\d_]+")

GOOD, BAD, NEAR, UNDECIDED = "good", "bad", "near", "short"


class Block:
    """``beside``: 0, or how its surroundings speak against it (NAMED weaker than PLACED);
    ``forms``: forms around it; ``home``: the article or main element around it, or 0;
    ``at``: its place on the page in steps."""

    __slots__ = ("parts", "linked", "beside", "forms", "home", "heading", "at")

    def __init__(self, frame: "Frame", at: int):
        self.parts: list[str] = []
        self.linked, self.heading, self.at = 0, False, at
        self.beside, self.home, self.forms = frame.beside, frame.home, frame.forms

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


class Frame:
    """An open element and what holds inside it."""

    __slots__ = ("tag", "beside", "home", "forms")

    def __init__(self, tag: str = "", beside: int = 0, home: int = 0, forms: tuple = ()):
        self.tag, self.beside, self.home, self.forms = tag, beside, home, forms


NAMED, PLACED = 1, 2


def speaks_against(name: str) -> bool:
    """Is the class or id made of words for what stands beside an article?"""
    names = [re.split(r"[-_]+", n) for n in name.lower().split()]
    if any(n[-1] in ARTICLE_WORDS for n in names):
        return False
    return any(all(p in MARKERS or p in NEUTRAL or p in ARTICLE_WORDS for p in n) and any(p in MARKERS for p in n) for n in names)


def beside(tag: str, attributes: str, within_article: bool) -> int:
    if tag in BESIDE or tag == "header" and not within_article:
        return PLACED
    if "=" not in attributes or tag in ("html", "body", "article", "main"):
        return 0
    out = 0
    for name, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if name.lower() == "role":
            if value.lower() in ROLES:
                return PLACED
        elif speaks_against(value):
            out = NAMED
    return out


def blocks_of(page: str) -> list[Block]:
    done: list[Block] = []
    root = Frame()
    stack: list[Frame] = []
    homes = forms = at = links = step = 0
    block = Block(root, 0)

    def flush():
        nonlocal block, step
        if block.parts:
            done.append(block)
            step += 1
        block = Block(stack[-1] if stack else root, step)

    def say(text: str):
        if text:
            block.parts.append(text)
            if links:
                block.linked += len(text.strip())

    def close(i: int):
        nonlocal step
        step += CROSSING * sum(f.tag in CONTAINERS for f in stack[i:])
        del stack[i:]

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        say(page[at : m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "a":
                links = max(0, links - 1)
            opened = [i for i, f in enumerate(stack) if f.tag == tag]
            if tag in INLINE and not opened:
                continue
            flush()
            if opened:
                links = links if tag in INLINE else 0
                close(opened[-1])
                block = Block(stack[-1] if stack else root, step)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in RAW:
            flush()
            end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag == "a":
            links += 1
        outer = stack[-1] if stack else root
        own = beside(tag, m.group(3), bool(outer.home))
        if tag in INLINE and not own:
            continue
        flush()
        links = links if tag in INLINE else 0
        if m.group(3).rstrip().endswith("/"):
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th") and outer.tag == tag:
            close(len(stack) - 1)
            outer = stack[-1] if stack else root
        frame = Frame(tag, PLACED if tag in HIDDEN else max(own, outer.beside), outer.home, outer.forms)
        if tag in ("article", "main") and not frame.beside and not frame.home:
            homes += 1
            frame.home = homes
        if tag == "form":
            forms += 1
            frame.forms = (*outer.forms, forms)
        step += CROSSING * (tag in CONTAINERS)
        stack.append(frame)
        block = Block(frame, step)
        block.heading = tag in HEADINGS
    say(page[at:])
    flush()
    return done


def by_rules(block: Block, text: str) -> str:
    """The first pass: length, link density, stop-word density."""
    n = len(text)
    if block.linked > MOST_LINKS * n:
        return BAD
    if n < SHORT:
        return UNDECIDED
    words = text.lower().split()
    stops = sum(w in STOP_WORDS for w in WORDS.findall(text.lower())) / max(1, len(words))
    if stops >= STOP_HIGH:
        return GOOD if n >= LONG else NEAR
    return NEAR if stops >= STOP_LOW or block.home else BAD


def first_pass(blocks: list[Block], texts: list[str], least: int = NAMED) -> list[str]:
    """Labels by the rules; blocks beside the article (by evidence of ``least`` strength) and
    blocks of forms without a good block are bad."""
    kinds = [BAD if b.beside >= least else by_rules(b, t) for b, t in zip(blocks, texts)]
    wrappers = {f for b, k in zip(blocks, kinds) if k == GOOD for f in b.forms}
    return [BAD if not wrappers.issuperset(b.forms) else k for b, k in zip(blocks, kinds)]


def second_pass(kinds: list[str], places: list[int], homes: list[int], headings: list[bool]) -> list[str]:
    """Undecided blocks take the label of the nearest decided neighbour.  Blocks of an
    article see its edges, good and one step off, instead of what lies beyond."""
    n = len(kinds)
    for stage in (NEAR, UNDECIDED):
        sides = []
        for order, step in ((range(n), -1), (range(n - 1, -1, -1), 1)):
            found: list = [None] * n
            last = edge = None  # (label, place) of a decided block, and of an article's edge
            home = 0
            for i in order:
                if homes[i] != home:
                    home = homes[i]
                    edge = (GOOD, places[i] + step) if home else None
                found[i] = edge or last
                if kinds[i] in (GOOD, BAD):
                    last, edge = (kinds[i], places[i]), None
            sides.append(found)
        out = list(kinds)
        for i, kind in enumerate(kinds):
            if kind != stage:
                continue
            left, right = sides[0][i], sides[1][i]
            if headings[i] and right is not None and right[0] == GOOD:
                out[i] = GOOD
            elif left is None and right is None:
                out[i] = GOOD if stage == NEAR else BAD
            elif left is None or right is None:
                out[i] = (left or right)[0]
            else:
                out[i] = (left if places[i] - left[1] <= right[1] - places[i] else right)[0]
        kinds = out
    return kinds


def decide(page: str | None):
    """(texts, labels of the first pass, labels) of a page's blocks."""
    blocks = [(b, t) for b in blocks_of(page or "") if (t := b.text())]
    texts = [t for _, t in blocks]
    blocks = [b for b, _ in blocks]
    for least in (NAMED, PLACED):
        first = first_pass(blocks, texts, least)
        homes = [0 if b.beside >= least else b.home for b in blocks]
        final = second_pass(first, [b.at for b in blocks], homes, [b.heading for b in blocks])
        if GOOD in final:
            break
    return texts, first, final


def main_text(page: str | None) -> str:
    texts, _, kinds = decide(page)
    return "\n\n".join(t for t, k in zip(texts, kinds) if k == GOOD)


def extract_rows(batches):
    for batch in batches:
        texts = [main_text(x) for x in common.strings(batch, "html")]
        yield pa.RecordBatch.from_arrays([*common.keep(batch, "page_id", "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(extract_rows, f"page_id {kind}, url string, text string, n_chars long")


def op4_block_rules(spark, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
