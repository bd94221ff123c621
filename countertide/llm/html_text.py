"""Main text of HTML pages by block rules in two passes (operator 6).

A page is cut into blocks at block-level tags. Blocks in menus, headers, footers, forms, adverts, notices, comments and
the like are out by their markup. The others are classified without context from link density, length and the share of
stop words: *good*, *bad* or, when too short or too odd to tell, *ambiguous*. In a second pass ambiguous blocks take the
label of the nearest decided blocks before and after (good if one of them is good), so that a short paragraph stays with
its article and a short label goes with its menu.

Markup that does not settle the matter is a feature of the rules. Article elements are believed if they hold at least half
of the letters that are good without context; otherwise all blocks of the page are judged, and an article element without
a good block (a teaser card, say) gives no short blocks. Names such as ``social`` or ``search`` that are part of a longer
name (``social-history``) make undecided blocks bad and leave good ones. Where no block is good, short blocks without many
links stay, those of article elements if there are any.

Defined results: a null or empty page gives the empty text; a page that is cut off is read as far as it goes; a very long
page is held as one list of blocks by one task and never cut; of nearest decided blocks equally near, either may make a
block inside an article good, and outside both must; repeated rows are extracted each; columns named text or n_chars are
replaced, all others kept; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import slices, table
from countertide.llm.registry import query

# Elements by their part in a page, and words of class, id and role that name what is not the article.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary
    table tbody td tfoot th thead title tr ul""".split()
)
OUT = frozenset(
    """nav footer aside form head menu dialog button select option datalist fieldset label input textarea noscript
    template iframe object canvas audio video map""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
NAMES_OUT = frozenset(
    """ad ads adv advert adverts advertisement advertising adbox adslot banner banners sponsor sponsored promo promotion
    promoted cookie cookies consent gdpr popup modal overlay toast sidebar sidenav aside menu menus nav navbar navigation
    navigationbar breadcrumb breadcrumbs pagination pager topbar toolbar footer header masthead comment comments
    commentlist respond disqus newsletter subscribe subscription searchbox complementary contentinfo""".split()
)
# Out where they are the whole name or stand beside words of arrangement; else a hint.
NAMES_HINT = frozenset(
    """notice notices alert alerts replies reply discussion reactions share sharing social related recommended signup login
    search widget widgets tags toc copyright disclaimer legal skip""".split()
)
NAMES_ARRANGE = frozenset(
    """area bar block box button buttons container content entries entry form group icon icons inner item items line link
    links list media panel post posts row section site text thread to top bottom left right wrap wrapper""".split()
)
STOP_WORDS = frozenset(
    """a an and are as at be by for from has have he her his i in is it its not of on or she so that the their they this
    to was we were which who will with you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour qui
    que sa se ses son sur un une vous
    als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach
    nicht noch nur oder sich sie sind so über um und von vor war wie wird zu zum zur
    al como con cual del el ella ellos era esta este fue hay las lo los más mi muy no para pero por porque se ser si sin
    sobre son su sus también un una unos y ya""".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|xmp|svg|math)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?>[^"'<>]|"[^"<>]*"|'[^'<>]*')*+|[^>]*)>
    |<[!?/][^>]*(?:>|\Z)
    |<[a-zA-Z][^<>]*\Z""",
    re.S | re.I | re.X,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")

#: Limits of the rules.
MUCH_LINKED, LITTLE_LINKED = 0.5, 0.2
SHORT, LONG = 70, 200
FEW_STOP, MANY_STOP = 0.10, 0.20


class Block:
    """``article`` numbers the outermost article element around the block from 1; 0 is none. ``hinted``: by its names."""

    __slots__ = ("text", "linked", "article", "heading", "hinted", "label")

    def __init__(self, text: str, linked: int, article: int, heading: bool, hinted: bool):
        self.text, self.linked, self.article, self.heading, self.hinted, self.label = text, linked, article, heading, hinted, ""


def _verdict(tag: str, attrs: str, inside: bool) -> tuple[bool, bool]:
    """(out, hinted) of an element by its tag, names and visibility."""
    if tag in OUT or (tag == "header" and not inside):
        return True, False
    if tag in ("html", "body", "article", "main") or not attrs:
        return False, False
    if _HIDDEN.search(attrs):
        return True, False
    hinted = False
    for m in _NAMED.finditer(attrs):
        for value in (m[2] or m[3] or m[4] or "").lower().split():
            parts = {p for p in re.split(r"[-_]+", value) if p}
            if value in NAMES_OUT or not NAMES_OUT.isdisjoint(parts):
                return True, False
            if not NAMES_HINT.isdisjoint(parts):
                if parts <= NAMES_HINT | NAMES_ARRANGE:
                    return True, False
                hinted = True
    return False, hinted


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order, without those whose markup puts them outside the article."""
    found: list[Block] = []
    open_tags: list[tuple[str, bool, bool]] = []
    text: list[str] = []
    state = {"linked": 0, "out": 0, "hinted": 0, "inside": 0, "articles": 0, "links": 0, "heading": False}

    def put(raw: str) -> None:
        if raw and not state["out"]:
            text.append(raw)
            if state["links"]:
                state["linked"] += len(" ".join(html.unescape(raw).split()))

    def end_block() -> None:
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                article = state["articles"] if state["inside"] else 0
                found.append(Block(whole, state["linked"], article, state["heading"], state["hinted"] > 0))
            text.clear()
        state["linked"] = 0

    def left(tag: str, was_out: bool, was_hinted: bool) -> None:
        state["out"] -= was_out
        state["hinted"] -= was_hinted
        state["inside"] -= tag in ARTICLE
        state["links"] -= tag == "a"

    at = 0
    for m in _TOKEN.finditer(page):
        put(page[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in BLOCKS:
            end_block()
        if tag == "br":
            put(" ")
        if m["close"]:
            state["heading"] = False if tag in BLOCKS else state["heading"]
            if any(t[0] == tag for t in reversed(open_tags)):
                while True:
                    closed = open_tags.pop()
                    left(*closed)
                    if closed[0] == tag:
                        break
        elif tag not in VOID and not m["attrs"].endswith("/"):
            if tag in BLOCKS:
                state["heading"] = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            # A paragraph, a list item or a link ends where the next one begins.
            if open_tags and tag in ("p", "li", "a", "option", "dt", "dd", "tr", "td", "th") and open_tags[-1][0] == tag:
                left(*open_tags.pop())
            out, hinted = _verdict(tag, m["attrs"], state["inside"] > 0)
            open_tags.append((tag, out, hinted))
            state["out"] += out
            state["hinted"] += hinted
            state["articles"] += tag in ARTICLE and not state["inside"]
            state["inside"] += tag in ARTICLE
            state["links"] += tag == "a"
    put(page[at:])
    end_block()
    return found


def classify(blocks: list[Block], believed: bool) -> None:
    """First pass: labels without context. ``believed``: whether an article element speaks for its blocks."""
    for b in blocks:
        words = _LETTERS.findall(b.text.lower())
        stop = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        linked = b.linked / len(b.text)
        inside = believed and b.article > 0
        if linked > MUCH_LINKED and not (inside and len(b.text) >= LONG):
            b.label = "bad"
        elif b.heading or len(b.text) < SHORT:
            b.label = "bad" if b.hinted and not b.heading else "ambiguous"
        elif stop >= MANY_STOP and linked <= LITTLE_LINKED or stop >= FEW_STOP and len(b.text) >= LONG:
            b.label = "good"
        elif (inside or stop >= FEW_STOP) and not b.hinted:
            b.label = "ambiguous"
        else:
            b.label = "bad"


def inherit_labels(blocks: list[Block], believed: bool) -> None:
    """Second pass: ambiguous blocks by their nearest decided neighbours."""
    before, after = "", [""] * len(blocks)
    following = ""
    for k in range(len(blocks) - 1, -1, -1):
        after[k] = following
        if blocks[k].label != "ambiguous":
            following = blocks[k].label
    for k, b in enumerate(blocks):
        if b.label != "ambiguous":
            before = b.label
            continue
        near = {before, after[k]} - {""}
        if believed and b.article:
            b.label = "good" if "good" in near or not near or b.linked == 0 else "bad"
        else:
            # A heading belongs to what follows it; other short blocks must lie among good ones.
            b.label = "good" if (b.heading and after[k] == "good") or near == {"good"} else "bad"


def _without_cards(blocks: list[Block]) -> list[Block]:
    """Drop the blocks of article elements that hold more than headings and no good block."""
    good = {b.article for b in blocks if b.label == "good"}
    more = {b.article for b in blocks if not b.heading}
    return [b for b in blocks if not b.article or b.article in good or b.article not in more]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    classify(blocks, believed=False)
    inside = sum(len(b.text) for b in blocks if b.label == "good" and b.article)
    outside = sum(len(b.text) for b in blocks if b.label == "good" and not b.article)
    if not inside and not outside:
        # Nothing is good by itself: article elements speak where they are, else what is not mostly links stays.
        if any(b.article for b in blocks):
            blocks = [b for b in blocks if b.article]
            classify(blocks, believed=True)
            inherit_labels(blocks, believed=True)
        else:
            for b in blocks:
                b.label = "good" if b.label == "ambiguous" and b.linked <= LITTLE_LINKED * len(b.text) else "bad"
    elif inside >= outside:
        blocks = _without_cards([b for b in blocks if b.article])
        classify(blocks, believed=True)
        inherit_labels(blocks, believed=True)
    else:
        blocks = _without_cards(blocks)
        inherit_labels(blocks, believed=False)
    return "\n".join(b.text for b in blocks if b.label == "good")


def _texts(batches):
    for batch in batches:
        for part in slices(batch, "_html"):
            texts = [main_text(x) for x in part.column("_html").to_pylist()]
            kept = [n for n in part.schema.names if n != "_html"]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*kept, "text", "n_chars"],
            )


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of the markup and of columns that bore these names."""
    kept = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").cast("string").alias("_html"))
    schema = source.drop("_html").schema.add("text", "string").add("n_chars", "long")
    return source.mapInArrow(_texts, schema)


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
