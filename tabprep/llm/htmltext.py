"""Main text of web pages by two-pass block rules.

A page becomes blocks: runs of text between block-level tags, each with its
words, the share of them inside links, the share of stop words, the article it
stands in and the suspect containers around it (elements such as ``form``, or a
class, id or role named like page furniture).

First pass: a block mostly made of links, or a short one that reads like a
notice, is bad; one with enough words and stop words is good (on a page in
which stop words of no known language occur, enough words or letters and the
end of a sentence do); the rest, short ones above all, is open.  Suspect
containers make their blocks bad, unless they hold most of the page's good
text and no article holds the rest: a name is evidence, not a veto.  Text
outside articles is bad if the articles hold at least as much good text.

Second pass: an open block takes the label of the nearest decided neighbour of
its region (a heading that of the next one); at equal distances the article
counts for the text.

Elements that never hold main text (navigation, footers, scripts, styles) are
left out while the page is read, in time linear in its length.  Pages are
independent rows, so Spark only has to spread them.
"""

from __future__ import annotations

import html
import re
from collections import Counter, namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, text_of

by_value(__name__)

# HTML elements by what they mean for text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
                   "option p pre section summary table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object xmp noframes".split())
FURNITURE = frozenset("nav footer aside head menu button select dialog".split())
SUSPECT = frozenset("form header".split())  # may wrap a whole page, or a title
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = frozenset("li p td th tr dt dd option".split())
# Words of class, id and role attributes that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo related replies reply respond search share sharing sidebar signup skip "
    "social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets complementary "
    "contentinfo dialog alert".split())
# Parts of such names that only say where or what a box is, that
# the name is about the text, that it is about something else, or comments.
BOX_WORDS = frozenset(
    "area areas bar bars block blocks body bottom box boxes button buttons center column container content form "
    "group holder icon icons inner item items left link links list main modal module outer overlay panel region right "
    "row section side slot strip text title top unit wrap wrapper zone".split())
TEXT_WORDS = frozenset("article content entry main page post story text".split())
ABOUT_WORDS = frozenset("with without has have no not is hide show open closed enable disable enabled disabled".split())
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
TITLE_WORDS = frozenset("header masthead banner".split())
# How short notices and calls to the reader begin (four languages).
NOTICE = re.compile(
    r"(?:subscribe|sign up|log in|sign in|cookies?\b|cookie notice|we use cookies|accept (?:all )?cookies|share this|follow us|"
    r"advertisement|sponsored|read more|related (?:articles|posts|stories)|newsletter|leave a (?:comment|reply)|"
    r"abonnieren|anmelden|anzeige\b|werbung|mehr lesen|teilen|s'abonner|abonnez-vous|publicité|lire la suite|partager|"
    r"suscr[ií]bete|publicidad|leer más|compartir)", re.I)
# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that for it was on are as with be at by this from or an have not had but which "
    "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er "
    "le la les de des du et à un une est en que qui dans pour par sur au avec ne se pas plus ce il "
    "el los las del y que se con su para no lo como más pero sus por al".split())

GOOD_WORDS, GOOD_STOPS, BAD_LINKS = 10, 0.1, 0.5
#: Words of a notice, at most; letters that count as enough words in scripts
#: without spaces; share of stop words below which their language is unknown.
NOTICE_WORDS, GOOD_LETTERS, KNOWN_STOPS = 8, 25, 0.03

TAG = re.compile(r"""<(?:!--(?P<note>.*?)(?:-->|\Z)|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)"""
                 r"""(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>|[!?/][^>]*>)""", re.S)
LOOSE = re.compile(r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>[^>]*)>")  # a quote is not closed
MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""\s(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)


#: What the reader knows of a block; ``region`` 0 is outside articles, and
#: ``boxes`` are the numbers of the suspect containers around it.
Block = namedtuple("Block", "text links region boxes heading", defaults=(0, (), False))


def _suspect_name(name: str) -> str:
    """What a class, id or role says: ``comments``, ``title``, ``box`` or
    nothing.  In names of several parts the last one counts, after parts that
    only say where a box is; ``with-sidebar`` says nothing of the element."""
    parts = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if x]
    if not parts or parts[0] in ABOUT_WORDS:
        return ""
    while len(parts) > 1 and parts[-1] in BOX_WORDS:
        parts.pop()
    if parts[-1] not in FURNITURE_WORDS:
        return ""
    return "comments" if parts[-1] in COMMENT_WORDS else "title" if parts[-1] in TITLE_WORDS else "box"


def _suspect(name: str, attrs: str, in_article: bool) -> str:
    """Whether an element is a suspect container, and of which sort."""
    if name in ("html", "body", "main"):
        return ""
    said = set()
    if "=" in attrs:
        names = [x for m in MARK.finditer(attrs) for x in "".join(m.groups("")[1:]).split()]
        said = {_suspect_name(x) for x in names} - {""}
        if "comments" not in said and any(x.lower() in TEXT_WORDS for x in names):
            return ""
    if "comments" in said:
        return "comments"
    if name == "article" or in_article and (name == "header" or said == {"title"}):
        return ""
    return "box" if said or name in SUSPECT else ""


def blocks_of(page: str) -> tuple[list[Block], list[str]]:
    """The blocks outside elements that never hold main text, in order, and
    the sorts of the suspect containers.  Articles are regions 1, 2, ..."""
    out: list[Block] = []
    boxes: list[str] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple] = [("", 0, 0, 0, (), False)]  # name, furniture depth, region, link depth, boxes, heading
    blocks_at = [0]  # places of block elements in the stack
    count: Counter = Counter()  # open elements by name
    regions, position, n, quotes = 0, 0, len(page), True

    def flush() -> None:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                linked = sum(len(t.strip()) for t, link in parts if link)
                _, _, region, _, around, heading = stack[-1]
                out.append(Block(text, linked / max(1, sum(len(t.strip()) for t, _ in parts)), region, around, heading))
            parts.clear()

    def say(a: int, b: int) -> None:
        if a < b and not stack[-1][1]:
            parts.append((html.unescape(page[a:b]), bool(stack[-1][3])))

    def close(depth: int) -> None:
        count.subtract(x[0] for x in stack[depth:])
        del stack[depth:]
        while blocks_at[-1] >= depth:
            blocks_at.pop()

    while position < n:
        at = page.find("<", position)
        if at < 0:
            say(position, n)
            break
        tag = TAG.match(page, at) if quotes else None
        if not tag:
            tag = LOOSE.match(page, at)
            quotes = quotes and not tag  # a quote that is never closed would be looked for again and again
        if not tag:
            # a bare "<" is text; an unfinished tag ends the page
            unfinished = re.match(r"</?[A-Za-z!?]", page[at:at + 3]) and page.find(">", at) < 0
            say(position, at if unfinished else at + 1)
            position = n if unfinished else at + 1
            continue
        say(position, at)
        position = tag.end()
        name = (tag.groupdict().get("name") or "").lower()
        if not name:
            continue
        attrs = tag["attrs"] or ""
        if tag["end"]:
            if name in BLOCKS:
                flush()
            if count[name] > 0:  # what is searched is closed with it
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                close(depth)
            continue
        if name in BLOCKS:
            flush()
        elif name == "br" and not stack[-1][1]:
            parts.append((" ", False))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, position)
            position = end.end() if end else n
            continue
        if name in VOID or attrs.endswith("/") and name not in BLOCKS:
            continue
        if name in BLOCKS and blocks_at[-1]:
            # an open paragraph ends where a block starts, an item where its like does
            last = stack[blocks_at[-1]][0]
            if last == "p" or last == name and name in CLOSES_ITSELF:
                close(blocks_at[-1])
        _, furniture, region, link, around, heading = stack[-1]
        furniture += name in FURNITURE or bool("hidden" in attrs or "display" in attrs) and bool(HIDDEN.search(attrs))
        sort = "" if furniture else _suspect(name, attrs, region > 0)
        if sort:
            boxes.append(sort)
            around = (*around, len(boxes) - 1) if len(around) < 16 else around
        if name in ("article", "main") and not furniture and not region and not any(boxes[b] == "comments" for b in around):
            regions += 1
            region = regions
        if name in BLOCKS:
            blocks_at.append(len(stack))
        count[name] += 1
        stack.append((name, furniture, region, link + (name == "a"), around, heading or name in HEADINGS))
    flush()
    return out, boxes


def _stops(words: list[str]) -> int:
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words)


def decide(blocks: list[Block], boxes: list[str]) -> list[bool]:
    """Which blocks belong to the main text (the two passes)."""
    words = [b.text.lower().split() for b in blocks]
    stops = [_stops(w) for w in words]
    longer = [i for i, w in enumerate(words) if len(w) >= GOOD_WORDS]
    known = sum(stops[i] for i in longer) >= KNOWN_STOPS * sum(len(words[i]) for i in longer) and bool(longer)
    first: list[bool | None] = []
    for b, w, s in zip(blocks, words, stops):
        if b.links > BAD_LINKS or len(w) <= NOTICE_WORDS and NOTICE.match(b.text):
            first.append(False)
        elif known:
            first.append(True if len(w) >= GOOD_WORDS and s >= GOOD_STOPS * len(w) else None)
        else:  # no language that we know
            letters = sum(c.isalpha() for c in b.text)
            ends = sum(c in ".!?。！？।؟" for c in b.text)
            enough = len(w) >= GOOD_WORDS or letters >= GOOD_LETTERS * max(1, len(w))
            first.append(True if enough and ends else None)

    # good text, in all and by container and region
    size = [len(b.text) if label else 0 for b, label in zip(blocks, first)]
    total, held, regional = sum(size), Counter(), Counter()
    for b, n in zip(blocks, size):
        for box in b.boxes:
            held[box] += n
    # a container with most of the good text is no furniture, unless an article stands beside it
    beside = lambda box: any(b.region and box not in b.boxes for b in blocks)
    lifted = {box for box, n in held.items() if boxes[box] != "comments" and 2 * n > total and not beside(box)}
    bad = [any(box not in lifted for box in b.boxes) for b in blocks]
    first = [False if out else label for label, out in zip(first, bad)]
    for b, n, out in zip(blocks, size, bad):
        regional[b.region] += 0 if out else n
    inside = sum(n for r, n in regional.items() if r)
    if any(b.region and not out for b, out in zip(blocks, bad)) and inside >= regional[0]:
        first = [label if b.region else False for label, b in zip(first, blocks)]

    def nearest(step: int) -> list[tuple[int, bool] | None]:
        """(distance, label) of the nearest decided block of the same region."""
        found: list = [None] * len(blocks)
        last: dict[int, tuple[int, bool]] = {}
        for i in range(len(blocks))[::step]:
            region = blocks[i].region
            if region in last:
                found[i] = (abs(i - last[region][0]), last[region][1])
            if first[i] is not None and not bad[i]:  # boxes inside an article say nothing of what stands beside them
                last[region] = (i, first[i])
        return found

    final = []
    for label, before, after, b in zip(first, nearest(1), nearest(-1), blocks):
        if label is None:
            if b.heading and after:
                label = after[1]
            elif before and after and before[0] != after[0]:
                label = min(before, after)[1]
            elif before and after and before[1] != after[1]:
                label = b.region > 0
            elif before or after:
                label = (before or after)[1]
            else:  # nothing near is decided
                label = b.region > 0
        final.append(label)
    return final


def main_text(page: str) -> str:
    blocks, boxes = blocks_of(page)
    return "\n".join(b.text for b, keep in zip(blocks, decide(blocks, boxes)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url_col, text, n_chars`` (code points).

    Defined cases: a null or empty page, or one without main text, gives an
    empty text; cut-off pages give what stands before the cut; repeated rows
    get a row each; null ids and addresses stay null; other columns are
    ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = batch["page"].map(main_text)
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": text, "n_chars": text.map(len)})

    kind = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url"),
                         text_of(html_col).alias("page"))
            .mapInPandas(run, "id string, url string, text string, n_chars long")
            .select(F.col("id").cast(kind).alias(id_col), F.col("url").alias(url_col), "text", "n_chars"))
