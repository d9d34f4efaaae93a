"""Main text of web pages by a site style tree.

Pages of one host are merged into a style tree, copies of one page (the same text blocks in the same branches) as one:
a branch is a path of presentation nodes (tag and class names, siblings merged), its features are the text blocks seen
below it. A feature that c of the branch's m pages share has entropy log_m(c) and importance 1 minus that: 0 for what
all pages say, 1 for what one page says. The branch is as important as its most important feature, so an important
block or branch keeps all that it is in. Branches under
MIN_IMPORTANCE that MIN_PAGES pages hold are cut out of each page, with branches whose presentation alone marks
them (navigation, footers, forms, adverts, reader comments, ...: importance 0 by definition). Names do so if they are
whole ("ad", "comment-list") and no main or article element is or stands in the branch; one part of a name ("no-sidebar") only
raises what the tree asks of the branch to MIN_NAMED_IMPORTANCE. Where a page has an
article (or main) element, the rest goes; plain text blocks inside it are the article and aren't judged.

Defined results: null or empty html gives an empty text; repeated rows give equal results; a page
without host is judged with the other hostless ones; an empty table gives no rows; other columns are ignored.
A broken page gives what an HTML parser would see: an unfinished tag or comment at the end is markup, a lone "<"
is text, unclosed elements end with their parent.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import saved

MIN_PAGES = 10
MIN_IMPORTANCE = 0.2
#: The same for branches of which a part of a class name or id, such as the sidebar of no-sidebar, marks them.
MIN_NAMED_IMPORTANCE = 0.5
#: Rows of the table of cut branches up to which it is broadcast (about 100 bytes each); beyond, the join is salted.
BROADCAST_ROWS = 50_000
SALTS = 32

# Element names by their role in HTML, and class names that mark presentation-only branches.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("head nav footer aside form script style textarea title noscript iframe xmp noembed noframes template button select datalist input label dialog menu object svg canvas audio video map math".split())
NOISE_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer discussion disqus gdpr masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related replies respond share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar alertdialog".split())
# A name made of noise names and these alone marks like a noise name itself; other parts may negate or qualify it.
CONTAINER_NAMES = frozenset("area bar block box container form inner items links list section slot thread wrap wrapper".split())
EDGE_NAMES = frozenset("header footer site-header site-footer page-header page-footer top-bar topbar bottom-bar".split())
CLOSERS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
JUDGED = frozenset("div section ul ol dl table center details figure fieldset header".split())

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</[^A-Za-z>][^>]*+(?:>|\Z)|</>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|(?<==)"[^"]*+"|(?<==)'[^']*+'|(?<=\s)(?<==\s)"[^"]*+"|(?<!=)["'])*+)(?:>|\Z|["'].*\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("above", "article", "cut", "holds", "key", "named", "noise", "path", "tag")

    def __init__(self, tag: str, above: Node | None, cut: bool, article: int, path: str, key: int | None, noise: bool, named: bool):
        self.tag, self.above, self.cut, self.article, self.path, self.key, self.noise, self.named = tag, above, cut, article, path, key, noise, named
        self.holds = False


def _whole(name: str) -> bool:
    """A name that marks by itself."""
    parts = [x.lower() for x in NAME.split(name) if x]
    return name.lower() in EDGE_NAMES or any(x in NOISE_NAMES for x in parts) and all(x in NOISE_NAMES or x in CONTAINER_NAMES for x in parts)


def _marks(attributes: str) -> tuple[list[str], bool, bool, bool]:
    """Class names, and whether the attributes' roles and states, a whole name or a part of one mark the element as no part of the text."""
    names, cut, noise, named = [], False, False, False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "class":
            names += value.split()
        if key in ("class", "id"):
            noise |= any(map(_whole, value.split()))
            named |= any(y.lower() in NOISE_NAMES for x in value.split() for y in NAME.split(x))
        elif key == "role":
            cut |= value.lower() in NOISE_ROLES
        elif key == "hidden":
            cut |= value.lower() != "until-found"
        else:
            cut |= value.lower() == "true"
    return names, cut, noise, named and not noise


def text_blocks(page: str, host: str) -> list[tuple[str, Node]]:
    """Text blocks in page order with the node that holds each; character references are decoded, cut branches left out."""
    top = Node("", None, False, 0, "", None, False, False)
    node, out, piece, at = top, [], [], 0

    def end_block() -> None:
        if piece:
            words = references.unescape("".join(piece)).split()
            if words:
                out.append((" ".join(words), holder))
            piece.clear()

    def pop_to(tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        nonlocal node
        found, x = None, node
        while x is not top and x.tag not in stops:
            if x.tag in tags:
                found = x
            x = x.above
        if found is not None:
            node = found.above

    holder = top
    while True:
        m = TOKEN.search(page, at)
        chunk = page[at : m.start()] if m else page[at:]
        if chunk and not node.cut:
            if not piece:
                holder = node
            piece.append(chunk)
        if m is None:
            break
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br" or tag in BLOCK:
            if not node.cut:
                end_block()
        if m[1]:
            x = node
            while x is not top and x.tag != tag:
                x = x.above
            if x is not top:
                node = x.above
                if tag in BLOCK:
                    end_block()
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            pop_to(("p",), ("button", "table", "td", "th", "caption", "object"))
        if tag in CLOSERS:
            pop_to(CLOSERS[tag], SCOPES[tag])
        names, cut, noise, named = _marks(m[3]) if m[3] else ([], False, False, False)
        noise &= tag not in ("html", "body", "main", "article")
        cut |= noise and tag not in BLOCK  # within a block
        cut = node.cut or ((cut or tag in DROPPED) and tag not in ("html", "body")) or (tag == "header" and not node.article)
        article = max(node.article, 2 if tag == "article" else 1 if tag == "main" or "role" in m[3] and re.search(r"role\s*=\s*[\"']?main", m[3]) else 0) if not cut else 0
        path, key = node.path, None
        if not cut and (tag == "main" or tag == "article" and not _in_noise(node)):
            x = node
            while x is not None and not x.holds:
                x.holds, x = True, x.above
        if not cut and (tag in JUDGED or names or named):
            path = f"{path}>{tag}{'.'.join(['', *sorted(re.sub(r'[0-9]+', '', x) for x in names)])}{'?' * named}"
            key = xxhash.xxh64_intdigest(f"{host}\x1f{path}") - (1 << 63)
        node = Node(tag, node, cut, article, path, key, noise, named and tag not in ("html", "body", "main", "article"))
    end_block()
    return [(text, node) for text, node in out if not _in_noise(node)]


def _in_noise(node: Node | None) -> bool:
    """A name marks a branch around the node; a branch that holds a main element, or an article of no such branch, is none."""
    while node is not None:
        if node.noise and not node.holds:
            return True
        node = node.above
    return False


def branch_keys(node: Node) -> dict[int, bool]:
    """Keys of the judged branches that hold a node, and whether a part of a name marks them."""
    found = {}
    while node is not None:
        if node.key is not None:
            found[node.key] = node.named and not node.holds
        node = node.above
    return found


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def main_text(page: str | None, url: str | None, low: frozenset[int] = frozenset()) -> str:
    """The page's main text without the branches in low."""
    blocks = text_blocks(page or "", host_of(url))
    level = max((n.article for _, n in blocks), default=0)
    return " ".join(t for t, n in blocks if n.article == level and not (low and not low.isdisjoint(branch_keys(n))))


def low_branches(pages: DataFrame) -> DataFrame:
    """host, branch of the style trees' branches under MIN_IMPORTANCE. Copies of a page meet by (branch, feature, page) in map-side sums first, so a hot host's rows meet as counts only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, branches, features, firsts, named, contents = [], [], [], [], [], []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                host, seen, known, whole = host_of(url), set(), set(), xxhash.xxh64()
                for text, node in text_blocks(page or "", host):
                    feature = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
                    whole.update(f"{node.path}\x1f{feature}\x1e".encode("utf-8", "surrogatepass"))
                    for key, marked in branch_keys(node).items():
                        if (key, feature) not in seen:
                            hosts.append(host)
                            branches.append(key)
                            features.append(feature)
                            firsts.append(int(key not in known))
                            named.append(int(marked))
                            seen.add((key, feature))
                            known.add(key)
                contents += [whole.intdigest() - (1 << 63)] * (len(hosts) - len(contents))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(branches, pa.int64()), pa.array(features, pa.int64()), pa.array(firsts, pa.int64()), pa.array(named, pa.int64()), pa.array(contents, pa.int64())], names=["host", "branch", "feature", "first", "named", "content"])

    rows = pages.select("url", "html").mapInArrow(run, "host string, branch long, feature long, first long, named long, content long").distinct()
    counts = rows.groupBy("host", "branch", "feature").agg(F.count("*").alias("c"), F.sum("first").alias("first"), F.min("named").alias("named"))
    tree = counts.groupBy("host", "branch").agg(F.sum("first").alias("m"), F.min("c").alias("c"), F.min("named").alias("named"))
    least = F.when(F.col("named") == 1, MIN_NAMED_IMPORTANCE).otherwise(MIN_IMPORTANCE)
    return tree.filter((F.col("m") >= MIN_PAGES) & (1 - F.log("c") / F.log("m") < least)).select("host", "branch")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    kept = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    low = saved(low_branches(kept))
    found = low.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, cuts = batch.column("url"), batch.column("low").to_pylist()
            texts = [main_text(h, u, frozenset(c or ())) for h, u, c in zip(batch.column("html").to_pylist(), urls.to_pylist(), cuts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    if not found:
        kept = kept.withColumn("low", F.lit(None).cast("array<long>"))
    else:
        site = F.regexp_replace(F.lower(F.regexp_extract("url", r"^[^/?#]*//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)), r"^www\.|^\[|\]$", "")
        by_host = low.groupBy("host").agg(F.collect_set("branch").alias("low"))
        kept = kept.withColumn("host", F.coalesce(site, F.lit("")))
        if found <= BROADCAST_ROWS:
            kept = kept.join(F.broadcast(by_host), "host", "left")
        else:
            salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            kept = kept.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    return kept.select("page_id", "url", "html", "low").mapInArrow(run, "page_id long, url string, text string, n_chars long")
