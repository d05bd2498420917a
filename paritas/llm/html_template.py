"""Main text of pages by equivalence classes of template tokens.

1. Every page becomes tokens: its tags, each with the path of elements it stands in, and the
   text runs outside article and main elements. Per host, tokens are grouped over its pages;
   a token's occurrence vector (how often it stands in each page) is summed up as its number
   of pages, its total and an exclusive-or of hashes of (page, count). Tokens with equal
   sums have equal vectors and form a class. Sums are partial per task, so a host with a
   third of all pages is one row per token and task; a host's pages are never gathered.
2. Classes that stand in at least ``min_share`` of a host's pages are kept. A class is valid
   for an element when its start and end tags are both in it: they open and close together
   on every page. Valid elements nest by their paths into the host's template: containers
   of the main text (article, main), parts that are not text (by element, by words of class
   and id, or mostly links), and constant runs.
3. Each page is read again with its host's template; what stands in the template's main
   slots is the text, without the parts that are no text by their element. Words of class and id
   drop boxes inside a main container only where the whole class says so (``share``, ``ad-slot``, not
   ``alert-story``), and never a container that holds the main one: text of a main container
   below such words counts when the page has no other. Where a page has no main container, all
   slots count that are not dropped parts, mostly links, or constant runs (text that stands in 90 per cent of
   a host's different pages and in three of them at least: with fewer pages nothing tells them from text).

The templates of all hosts are a written table; the planner broadcasts it when its size is
below the session's limit and otherwise joins by host, where AQE splits a hot host.

Defined cases: a null or empty page has an empty text; a null url belongs to the host "";
broken markup is closed by the next block or enclosing end tag; pages of a host with equal
html count as one page of its template, however many rows they are, and each row gets its
text; elements nested deeper than ``DEPTH`` count as children of the element at that depth, as in
browsers, so time and memory are linear in a page's length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import python_path, written
from paritas.llm.url_reputation import host_of

# HTML's own element classes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
MAIN = {"article", "main"}
NOT_TEXT = set("head nav aside footer form button select option dialog svg canvas object audio video map menu input".split()) | RAW
NOT_TEXT_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup menu nav navbar navigation breadcrumb breadcrumbs sidebar widget related recommended share sharing social "
    "footer header masthead topbar copyright pagination pager comment comments reply replies respond disqus login search toolbar skip hidden".split())

#: Boxes that a word of class or id may drop inside a main container, and words beside it that say nothing of their own.
BOXES = set("center div dl ol section span table ul".split())
PLAIN_WORDS = set("area articles bar block bottom box buttons container content frame group icons inner item items left links list outer panel posts right row section slot top unit wrapper zone".split())
DEPTH = 512

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)""", re.DOTALL)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


class Open:
    """The open elements, with the places of each name, of elements that are no inline ones, and of lists."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str]] = [("", "")]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.lists: list[int] = [0]

    def path(self) -> str:
        return self.stack[min(len(self.stack) - 1, DEPTH)][1]

    def push(self, name: str, path: str) -> None:
        k = len(self.stack)
        self.stack.append((name, path))
        self.at.setdefault(name, []).append(k)
        if name not in INLINE:
            self.blocks.append(k)
        if name in ("li", "ul", "ol"):
            self.lists.append(k)

    def pop(self) -> tuple[str, str]:
        name, path = self.stack.pop()
        k = len(self.stack)
        self.at[name].pop()
        for places in (self.blocks, self.lists):
            if places[-1] == k:
                places.pop()
        return name, path

    def shut(self, name: str):
        """Closes elements up to the last one of that name."""
        while True:
            gone, path = self.pop()
            yield "-", path, ""
            if gone == name:
                return


def tokens(page: str):
    """(kind, path, text) in page order: kind ``+`` a start tag, ``-`` an end tag, ``t`` a text run
    inside the path's element, ``/`` a break between blocks. A path's parent comes before it."""
    open_ = Open()
    at, n = 0, len(page)
    low = None
    while at < n:
        m = _TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            yield "t", open_.path(), page[at:end]
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            yield "/", "", ""
        if m[1] or m[4]:
            if open_.at.get(name):
                yield from open_.shut(name)
            continue
        if name in CLOSES_P and open_.at.get("p") and open_.blocks[-1] == open_.at["p"][-1]:
            yield from open_.shut("p")
        if name == "li" and open_.lists[-1] and open_.stack[open_.lists[-1]][0] == "li":
            yield from open_.shut("li")
        attrs = m[3] or m[6] or ""
        sig = name
        if "=" in attrs:
            marks = sorted(f"{a.lower()}={(x or y or z).lower()}" for a, x, y, z in _ATTR.findall(attrs))
            if marks:
                sig += "[" + re.sub(r"\d+", "0", " ".join(marks)).replace(">", "") + "]"
        path = open_.path() + ">" + sig
        yield "+", path, ""
        if name in VOID or attrs.endswith("/") and name not in INLINE | CLOSES_P:
            continue
        if name in RAW:
            low = low or page.lower()
            at = low.find("</" + name, at)
            at = n if at < 0 else at
            yield "-", path, ""
            if at < n:
                at = (low.find(">", at) + 1) or n
            yield "/", "", ""
            continue
        open_.push(name, path)


@lru_cache(maxsize=4096)
def element(step: str) -> tuple[str, frozenset[str], frozenset[str]]:
    """Name of a path's step, the words of its class, id and role, and those that are whole class names, with
    plain words at most beside them."""
    name, _, marks = step.partition("[")
    whole = set()
    for mark in marks.rstrip("]").split():
        parts = set(_WORD.findall(mark.rpartition("=")[2]))
        if parts & NOT_TEXT_WORDS and parts <= NOT_TEXT_WORDS | PLAIN_WORDS:
            whole |= parts
    return name, frozenset(_WORD.findall(marks)) - {"class", "id", "role"}, frozenset(whole)


def is_main(step: str) -> bool:
    name, words, _ = element(step)
    return (name in MAIN or "main" in words and name in ("div", "section")) and not words & {"comment", "comments"}


class Places:
    """Per path of a page: (in a main container, dropped, doubtful). Dropped parts are no text wherever they
    stand; doubtful ones only outside main containers."""

    def __init__(self, template: dict | None = None):
        self.main = None if template is None else set(template["main"])
        self.parts = set() if template is None else set(template["parts"])
        self.of: dict[str, tuple[bool, bool, bool]] = {"": (False, False, False)}

    def see(self, path: str) -> tuple[bool, bool, bool]:
        """The path's place; its parent was seen before."""
        if path not in self.of:
            above, _, step = path.rpartition(">")
            main, dropped, doubtful = self.of[above]
            name, words, whole = element(step)
            own = is_main(step) and (self.main is None or path in self.main)
            comments = words & {"comment", "comments"} and name not in ("html", "body") and (name in BOXES | MAIN | {"li"} or not main)
            dropped |= name in NOT_TEXT or name == "header" and not main or bool(comments)
            if main:
                dropped |= name in BOXES and bool(whole)
            elif not own and name not in ("html", "body"):
                doubtful |= bool(words & NOT_TEXT_WORDS) and not is_main(step) or path in self.parts
            self.of[path] = main or own, dropped, doubtful
        return self.of[path]


def _run_token(path: str, text: str) -> str:
    return path + "\0" + " ".join(text.split())


def page_tokens(page: str) -> dict[str, list[int]]:
    """token -> [count, characters of text, characters in links] of a page."""
    out: dict[str, list[int]] = {"": [1, 0, 0]}
    own: dict[str, list[int]] = {}
    places = Places()
    for kind, path, text in tokens(page):
        if kind == "/":
            continue
        if kind == "t":
            if places.see(path)[0] or text.isspace():
                continue
            chars = own.setdefault(path, [0])
            chars[0] += len(text)
            key = _run_token(path, text)
        else:
            if kind == "+":
                places.see(path)
            key = kind + path
        out.setdefault(key, [0, 0, 0])[0] += 1
    for path, (chars,) in own.items():  # once per path, to all elements around it
        steps = path.split(">")
        link = any(s == "a" or s.startswith("a[") for s in steps)
        for k in range(2, len(steps) + 1):
            c = out.setdefault("+" + ">".join(steps[:k]), [0, 0, 0])
            c[1] += chars
            c[2] += chars * link
    return out


def deduce(classes: list[list[tuple[str, int, int]]]) -> dict:
    """Template of a host from its classes of (token, characters, characters in links)."""
    main, parts, constant = [], [], []
    for c in classes:
        have = {t for t, _, _ in c}
        for token, chars, links in c:
            if "\0" in token:
                constant.append(token)
            elif token.startswith("+"):
                path = token[1:]
                step = path.rpartition(">")[2]
                name = element(step)[0]
                valid = "-" + path in have or name in VOID
                if valid and is_main(step) and not any(element(s)[0] in NOT_TEXT for s in path.split(">")):
                    main.append(path)
                elif valid and name not in INLINE | {"html", "body"} and chars and links > 0.6 * chars:
                    parts.append(path)
    return {"main": sorted(main), "parts": sorted(parts), "constant": sorted(constant)}


def main_text(page: str, template: dict) -> str:
    """Text of the page's slots that hold main text under its host's template."""
    constant, places = set(template["constant"]), Places(template)
    blocks: list[tuple[int, list[str]]] = []  # how sure: 2 main, 1 main below doubtful containers, 0 outside
    new = True
    for kind, path, text in tokens(page):
        if kind == "/":
            new = True
        elif kind == "+":
            places.see(path)
        elif kind == "t":
            main, dropped, doubtful = places.see(path)
            if dropped or not main and (doubtful or _run_token(path, text) in constant):
                continue
            sure = (2 - doubtful) if main else 0
            if new or blocks[-1][0] != sure:
                blocks.append((sure, []))
                new = False
            blocks[-1][1].append(text)
    cleaned = ((sure, " ".join(html.unescape("".join(t)).split())) for sure, t in blocks)
    found = [(sure, t) for sure, t in cleaned if t]
    best = max((sure for sure, _ in found), default=0)
    return " ".join(t for sure, t in found if sure == best)


def _explode(batches):
    for b in batches:
        cols: list[list] = [[], [], [], [], [], []]
        for sign, host, page in zip(*(b.column(n).to_pylist() for n in ("page", "host", "html"))):
            for token, (n, chars, links) in page_tokens(page or "").items():
                for c, v in zip(cols, (sign, host, token, n, chars, links)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                                         ["page", "host", "token", "n", "chars", "links"])


def _deduce(batches):
    for b in batches:
        found = [json.dumps(deduce([[(t["token"], t["chars"], t["links"]) for t in c["tokens"]] for c in classes])) for classes in b.column("classes").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(found, pa.string())], ["host", "template"])


def _different(pages: DataFrame) -> DataFrame:
    """``page, host, html``: each html of a host once. Hashes are counted first; only html that
    stands in several rows is shuffled, once per task."""
    signed = pages.select("host", F.coalesce("html", F.lit("")).alias("html")).select(F.xxhash64("html").alias("page"), "host", "html")
    again = written(signed.groupBy("host", "page").count().filter("count > 1").select("host", "page"))
    if again.isEmpty():
        return signed
    once = signed.join(again, ["host", "page"], "left_anti").select(signed.columns)
    return once.unionByName(signed.join(again, ["host", "page"], "left_semi").select(signed.columns).distinct())


def templates(pages: DataFrame, min_share: float = 0.1) -> DataFrame:
    """``host, template`` (JSON) of ``pages(host, html)``."""
    python_path(pages.sparkSession)
    seen = (_different(pages).mapInArrow(_explode, "page long, host string, token string, n int, chars long, links long")
            .withColumn("mark", F.xxhash64("page", "n"))
            .groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"), F.bit_xor("mark").alias("mark"),
                                          F.sum("chars").alias("chars"), F.sum("links").alias("links")))
    seen = written(seen.filter((F.col("pages") > 1) | F.col("token").startswith("+") | F.col("token").startswith("-") | (F.col("token") == "")))
    sizes = seen.filter(F.col("token") == "").select("host", F.col("pages").alias("of"))
    often = (seen.join(sizes, "host").filter((F.col("pages") >= min_share * F.col("of")) & (F.col("token") != ""))
             .filter(~F.col("token").contains("\0") | (F.col("pages") >= F.greatest(F.lit(3), 0.9 * F.col("of")))))
    # At most (tokens of a page) / min_share rows a host, however many pages it has.
    classes = (often.groupBy("host", "pages", "total", "mark").agg(F.collect_list(F.struct("token", "chars", "links")).alias("tokens"))
               .groupBy("host").agg(F.collect_list(F.struct("tokens")).alias("classes")))
    return classes.mapInArrow(_deduce, "host string, template string")


def _extract(batches):
    known: dict = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            b = batch.slice(at, 1000)
            out = []
            for page, t in zip(b.column("html").to_pylist(), b.column("template").to_pylist()):
                if t not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[t] = json.loads(t) if t else {"main": [], "parts": [], "constant": []}
                out.append(main_text(page or "", known[t]))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, min_share: float = 0.1) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``."""
    hosted = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    found = written(templates(hosted, min_share))
    return hosted.join(found, "host", "left").select("page_id", "url", "html", "template").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
