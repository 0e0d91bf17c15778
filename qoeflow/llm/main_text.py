"""Main text of web pages: site templates found by counting element subtrees per host, and page roles.

Every page is parsed to a tree. Each element's subtree has a hash (its name and, in order, the text and
subtrees inside). Spark counts on how many pages of a host each hash occurs; subtrees that recur across
many of them are the site's template and are deleted, however the site marks them up. What HTML or its
class and id names say about an element's role (menu, header, footer, sidebar, advert, form, comments)
works on single pages too, where nothing can recur.

Pages of a host with the same text count once. The prose of an article or main element (its headings,
paragraphs, lists, quotations, tables) is never taken for template, nor is what holds it, and elsewhere
nothing goes that holds half of the page's prose: copies of an article on one host are all articles.
"""

from __future__ import annotations

import functools
import hashlib
import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common

# HTML's own element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
HIDDEN = frozenset("head script style noscript template title iframe object svg math canvas audio video textarea select option datalist".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q ruby rp rt s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
                     "ol p pre section table ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tr td th figure figcaption".split())
#: Running prose: inside an article or main part, what holds any of it is no box.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl table figure".split())
# Elements and ARIA roles that are not main text, and words of class or id names that say so.
ASIDE = frozenset("nav footer aside form button menu dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs header masthead "
    "footer sidebar aside widget related share sharing social newsletter subscribe signup cookie cookies consent notice popup modal "
    "comment comments respond disqus login search pagination pager skip toolbar".split())
COMMENT_NAMES = frozenset(("comment", "comments", "commentlist", "respond"))
#: Role words that tell wherever they stand in a name (``gdpr-cookie-notice``, ``page-footer``), outside prose.
TELLING = COMMENT_NAMES | frozenset("disqus footer nav navbar navigation menu breadcrumb breadcrumbs cookie cookies consent newsletter popup pagination".split())
#: Words before a role word that turn it to a property of something else (``layout-with-sidebar``, ``has-menu``).
HAVING = frozenset("has have with without no not show hide open under above below".split())
#: Words before a role word that only say where on the page it is (``site-footer``), and after it what it is made of.
PLACES = frozenset(("site", "global", "left", "right"))
MADE_OF = frozenset("area bar block box buttons container content form group inner item items link links list outer posts section thread title wrap wrapper".split())
#: Names that are not decisive on an element which the page itself calls an article or main part.
MAIN = frozenset(("article", "main"))

TAG = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*)(>|$)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


@dataclass
class Element:
    name: str
    attributes: str = ""
    inside: list = field(default_factory=list)  # Elements and strings
    digest: bytes = b""
    holds_main: bool = False  # whether an article or main part is inside

    def attribute(self, wanted: str) -> str:
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == wanted:
                return html_lib.unescape(m[2] or m[3] or m[4] or "")
        return ""


def parse(source: str) -> Element:
    """A tree of the page; tags that are missing or cross are mended as far as block structure needs it."""
    root = Element("#page")
    stack, at = [root], 0
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each name in the stack

    def text(raw: str) -> None:
        if raw:
            stack[-1].inside.append(html_lib.unescape(raw))

    def innermost(names: frozenset | set) -> int:
        found = 0
        for n in names:
            open_ = places.get(n)
            if open_ and open_[-1] > found:
                found = open_[-1]
        return found

    def close(names: frozenset | set, stop: frozenset = frozenset()) -> None:
        i = innermost(names)
        if i and i >= innermost(stop):
            for e in stack[i:]:
                places[e.name].pop()
            del stack[i:]

    for m in iter(lambda: TAG.search(source, at), None):
        text(source[at:m.start()])
        at = m.end()
        if m[1] is not None:
            stack[-1].inside.append(m[1])
        if not m[3]:
            continue
        name = m[3].lower()
        if m[2]:
            if not places.get(name):
                continue
            close({name}, frozenset(("article", "main", "section", "div", "body", "td", "nav", "footer")) - {name} if name in INLINE or name in ("p", "li") else frozenset())
            continue
        if name in CLOSES_P:
            close({"p"}, frozenset(("article", "section", "div", "td", "th", "li", "blockquote", "main", "body")))
        if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            close({name} if name not in ("dt", "dd", "td", "th") else {"dt", "dd"} if name in ("dt", "dd") else {"td", "th"},
                  frozenset(("ul", "ol", "menu", "dl", "table", "tr", "select")) - {name})
        made = Element(name, m[4] or "")
        stack[-1].inside.append(made)
        if name in MAIN:
            for e in reversed(stack):
                if e.holds_main:
                    break
                e.holds_main = True
        if name in VOID or (m[4] or "").rstrip().endswith("/") and name in ("path", "use", "circle", "rect"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            body = source[at:end.start() if end else len(source)]
            at = end.end() if end else len(source)
            made.inside.append(body)
            continue
        places[name].append(len(stack))
        stack.append(made)
    text(source[at:])
    return root


def sign(element: Element) -> None:
    """Digests of all subtrees, bottom up (no recursion: pages may nest deeply)."""
    order, todo = [], [element]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += [c for c in e.inside if isinstance(c, Element)]
    for e in reversed(order):
        h = hashlib.blake2b(e.name.encode(), digest_size=8)
        for c in e.inside:
            if isinstance(c, Element):
                h.update(b"<" + c.digest)
            else:
                said = " ".join(c.split())
                if said:
                    h.update(b">" + said.encode("utf-8", "replace"))
        e.digest = h.digest()


def by_role(e: Element, prose: bool = False, holds_main: bool = False) -> bool:
    """Whether the element's name, role, class or id says that it is not main text.

    Inside an article and on an element of prose (``prose``) a class or id name counts only as a whole, made of
    role words alone: ``related-work`` is a heading's topic, ``related-posts`` a box. What holds the page's
    article or main part (``holds_main``) is a wrapper, whatever its name, but for comments.
    """
    if e.name in HIDDEN or e.name in ASIDE:
        return True
    return bool(e.attributes) and _told_by(e.name, e.attributes, prose, holds_main)


@functools.lru_cache(maxsize=1 << 14)
def _told_by(name: str, attributes: str, prose: bool, holds_main: bool) -> bool:
    """What the attributes say, kept: the same ones stand on many elements."""
    e = Element(name, attributes)
    if e.attribute("role").lower() in ASIDE_ROLES or "hidden" in e.attributes.lower().split():
        return True
    if e.name in ("html", "body", "main"):
        return False
    names = f"{e.attribute('class')} {e.attribute('id')}".lower().split()
    if e.name == "article" or holds_main:
        return any(_leading(words) in COMMENT_NAMES or COMMENT_NAMES & _told(words) for words in map(_words, names))
    if prose or e.name in PROSE:
        return any(_whole(words) for words in map(_words, names))
    return any(_leading(words) in ASIDE_NAMES or TELLING & _told(words) for words in map(_words, names))


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[_-]+", name) if w and not w.isdigit()] or [""]


def _leading(words: list[str]) -> str:
    """The first word of a name, after one that only says where; none where another word follows that it has."""
    return words[1] if len(words) == 2 and words[0] in PLACES else words[0]


def _told(words: list[str]) -> set[str]:
    """The words of a name but for those that something else is said to have, and all that follow them."""
    out = set()
    for w in words:
        if w in HAVING:
            break
        out.add(w)
    return out


def _whole(words: list[str]) -> bool:
    """Whether a name is a role and nothing else."""
    return any(w in ASIDE_NAMES or w in COMMENT_NAMES for w in words) and all(
        w in ASIDE_NAMES or w in COMMENT_NAMES or w in PLACES or w in MADE_OF for w in words)


def _walk(root: Element) -> Iterator[tuple[Element, bool, bool]]:
    """(element, inside an article's prose or the article itself, has a role aside) in page order, roles' insides left out."""
    todo = [(root, False)]
    while todo:
        e, within = todo.pop()
        aside = by_role(e, within, e.holds_main) or e.name == "header" and not (within or e.name in MAIN)
        within = within or e.name in MAIN
        yield e, within, aside
        if not aside:
            todo += [(c, within) for c in reversed(e.inside) if isinstance(c, Element)]


def _parts(root: Element) -> list[tuple[Element, bool, bool]]:
    """(element, has a role aside, may be template) in page order, roles' insides left out."""
    parts = list(_walk(root))
    # Characters of running prose inside each element, without those of roles aside.
    all_, prose = {}, {}
    for e, _, aside in reversed(parts):
        inside = [c for c in e.inside if isinstance(c, Element)]
        all_[id(e)] = 0 if aside else sum(len(c.strip()) for c in e.inside if isinstance(c, str)) + sum(all_[id(c)] for c in inside)
        prose[id(e)] = all_[id(e)] if e.name in RUNNING else 0 if aside else sum(prose[id(c)] for c in inside)
    whole = prose[id(root)]
    out = []
    for e, within, aside in parts:
        holds = prose[id(e)]
        stays = e.name in ("#page", "html", "body") or e.name in MAIN or not aside and (
            within and (holds > 0 or e.name in PROSE or e.name in INLINE or e.name in VOID) or holds > 0 and 2 * holds >= whole)
        out.append((e, aside, not stays))
    return out


def subtrees(root: Element) -> set[bytes]:
    """Digests of the subtrees that may be template: all elements but an article, its prose and what holds it."""
    sign(root)
    return {e.digest for e, aside, may_go in _parts(root) if may_go and not (aside and e.name in HIDDEN)}


def blocks(root: Element, template: frozenset | set) -> list[str]:
    """The main text's blocks in page order, white space in them made one space."""
    if template:
        sign(root)
    dropped = set()
    mains = []
    for e, aside, may_go in _parts(root) if template else ((e, aside, False) for e, _, aside in _walk(root)):
        if aside or may_go and e.digest in template:
            dropped.add(id(e))
        elif e.name in MAIN:
            mains.append(e)
    out: list[str] = []
    now: list[str] = []

    def end() -> None:
        said = " ".join("".join(now).split())
        if said:
            out.append(said)
        now.clear()

    # A main part that has text beside its articles counts as a whole, otherwise its articles do; without either, the body.
    articles = any(e.name == "article" for e in mains)
    roots, seen = [e for e in mains if e.name == "article" or not articles or _says(e, dropped)] or [root], set()
    for top in roots:
        todo: list = [top]
        while todo:
            e = todo.pop()
            if e is None:
                end()
            elif isinstance(e, str):
                now.append(e)
            elif id(e) not in dropped and id(e) not in seen:
                seen.add(id(e))
                if e.name == "br":
                    now.append(" ")
                    continue
                if e.name in INLINE:
                    todo += list(reversed(e.inside))
                    continue
                end()
                todo.append(None)
                todo += list(reversed(e.inside))
        end()
    return out


def _says(main: Element, dropped: set[int]) -> bool:
    """Whether the element has text that is neither dropped nor in an article."""
    todo: list = [main]
    while todo:
        e = todo.pop()
        if isinstance(e, str):
            if e.strip():
                return True
        elif id(e) not in dropped and e.name != "article":
            todo += e.inside
    return False


def host_of(url):
    """The host of a URL column (lower case, no port); an empty string where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


#: Pages of a host that share a part; a host with more is dealt over as many parts as that makes.
PART_PAGES = 5000


@dataclass(frozen=True)
class TemplateConfig:
    """A subtree is template when it is on ``pages`` pages of its host with different texts, however many
    pages the host has."""

    pages: int = 5


def templates(pages: DataFrame, cfg: TemplateConfig = TemplateConfig()) -> DataFrame:
    """(host, template): for each host the digests of its template subtrees.

    Digests are counted per (host, digest) with combining before the shuffle, once for each different text of
    the host; a host's list holds what recurs, not what its pages say.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "html"):
            hosts, bodies, digests = [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                root = parse(source or "")
                said = "\n".join(blocks(root, frozenset()))
                hosts.append(host)
                bodies.append(hashlib.blake2b(said.encode("utf-8", "replace"), digest_size=16).digest())
                digests.append(sorted(subtrees(root)))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(bodies, pa.binary()), pa.array(digests, pa.list_(pa.binary()))],
                                             ["host", "body", "digests"])

    counts = (pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(count, "host string, body binary, digests array<binary>")
              .groupBy("host", "body").agg(F.min("digests").alias("digests")).select("host", F.explode("digests").alias("digest"))
              .groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cfg.pages))
    return common.stored(counts.groupBy("host").agg(F.sort_array(F.collect_list("digest")).alias("template")), "templates")


def extract(pages: DataFrame, cfg: TemplateConfig = TemplateConfig()) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (blocks joined by a newline), n_chars.

    Cases: null or empty html has the text ''; pages without a host form a host of their own, the empty
    one; broken markup is read as far as it goes; character references are decoded, also without their
    semicolon where HTML allows it; a page whose every part is template or aside has the text ''; equal
    rows are pages of their own; other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "html"):
            texts = ["\n".join(blocks(parse(source or ""), frozenset(template or ())))
                     for source, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    # A host may have a third of all pages: its pages are dealt over parts, and its one list to each of these.
    # The table of such hosts, a row for each PART_PAGES pages at most, is broadcast.
    host = host_of(F.col("url"))
    large = (pages.select(host.alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PART_PAGES)
             .select("host", F.ceil(F.col("n") / PART_PAGES).alias("parts")))
    dealt = lambda df: df.join(F.broadcast(large), "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    rows = dealt(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"), host.alias("host")))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")))
    lists = dealt(templates(pages, cfg)).select("host", "template", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return (rows.join(lists, ["host", "part"], "left").select("page_id", "url", "html", "template")
            .mapInArrow(cut, "page_id long, url string, text string, n_chars long"))
