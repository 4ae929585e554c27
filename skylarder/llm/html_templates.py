"""Main text of pages by template deduction over the pages of a host.

A page is a sequence of tokens: opened elements, told apart by their path of structural
elements, and text nodes. Tokens of a host with the same occurrence vector (how often
they occur on each page) form an equivalence class; a vector is held as the sum of hashes of
(page, count), so classes come from one aggregation and no host is gathered anywhere.
Classes found on most pages of a host are kept if their tokens keep one order and nest;
together they are the host's template: elements that hold slots, and constant text. Only
that is collected per host: tokens on at least half of the pages, so at most twice as many
as a page has on average, each of bounded length. Every token of every page counts; a path
that grows long goes on from a hash, so deep pages stay small too. The main slot is the article
or main element of the template or, failing that, the slot with most varying text; a
page's text is what stands in it, without navigation, notices, adverts, forms and comments.

Defined cases: null html is the empty page, whose text is empty. A null or odd url belongs
to the host named ''. Null ids, repeated rows and extra columns change nothing but that
repeated rows weigh twice in the template. Unclosed elements are closed by what encloses
them. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: share of a host's pages that a template token is on
SUPPORT = 0.5
#: letters of a path; a longer one goes on from its hash, and ``outer`` says from where
LONG_PATH = 1000
#: tokens that a task gathers before it sends them on
SENT_TOKENS = 200_000

# Element names by their part in a page.
STRUCTURE = frozenset("html body div section article main nav header footer aside form table td ul ol dl figure".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strong sub sup time tt u var wbr ins del big".split())
RAW = frozenset("script style noscript template iframe textarea svg object".split())
NEVER = RAW | frozenset("head title nav aside form button select option footer menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = ("article", "main")
MARKS = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo sidebar side-bar menu nav navbar navigation breadcrumb "
    "breadcrumbs cookie cookies consent notice alert popup modal overlay newsletter subscribe signup share sharing social related "
    "recommended comment comments reply replies disqus footer masthead site-header widget widgets toolbar pagination pager".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

Event = tuple[str, bool, bool, str]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def _barred(name: str, attributes: str, inside_main: bool) -> bool:
    if name in NEVER or (name == "header" and not inside_main):
        return True
    for kind, a, b, c in _ATTRIBUTE.findall(attributes):
        words = (a or b or c).lower()
        if kind.lower() == "role":
            if words.strip() in ROLES:
                return True
        # a whole name, or one made of nothing but such words: "share-price-history" is none
        elif any(w in MARKS or all(p in MARKS for p in w.split("-")) for w in words.replace("_", "-").split()):
            return True
    return False


def _step(name: str, attributes: str) -> str:
    """An element's part of a path: its name and its first class or id."""
    for kind, a, b, c in _ATTRIBUTE.findall(attributes) if name in ("div", "section", "td", "ul") else ():
        if kind.lower() != "role" and (a or b or c).split():
            own = (a or b or c).split()[0]
            return f"{name}.{own if len(own) <= LONG_PATH else '~' + xxhash.xxh64_hexdigest(own.encode('utf-8', 'surrogatepass'))}"
    return name


def _joined(path: str, step: str, outer: dict[str, str]) -> str:
    """The path of an element inside ``path``; ``outer`` gets what a hash stands for."""
    if len(path) > LONG_PATH:
        head = f"~{xxhash.xxh64_hexdigest(path.encode('utf-8', 'surrogatepass'))}"
        outer[head] = path
        path = head
    return f"{path}/{step}"


def parent_of(path: str, outer: dict[str, str]) -> str:
    head = path.rpartition("/")[0]
    return outer.get(head, head)


def read_page(page: str, outer: dict[str, str] | None = None):
    """Yields ('open', path, barred) and ('text', path, barred, raw text) and ('gap',) in page order."""
    outer = {} if outer is None else outer
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # name, path, barred, inside main
    opened: Counter = Counter()
    at = 0
    lower = None
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            yield "text", stack[-1][1], stack[-1][2], text
        if not m:
            return
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if name not in INLINE:
            yield "gap", "", False, ""
        if m.group(1):
            closed = opened[name] == 0
            while not closed:
                last = stack.pop()[0]
                opened[last] -= 1
                closed = last == name
            continue
        _, path, barred, inside = stack[-1]
        attributes = m.group(3)
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                lower = lower or page.lower()
                end = lower.find(f"</{name}", at)
                close = page.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(page)
            continue
        barred = barred or _barred(name, attributes, inside)
        if name in STRUCTURE:
            path = _joined(path, _step(name, attributes), outer)
        yield "open", path if name in STRUCTURE else f"{path}>{name}", barred, ""
        # only elements that enclose others matter to paths; paragraphs and the like may stay unclosed
        if (name in STRUCTURE or barred) and name not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((name, path, barred, inside or name in MAIN))
            opened[name] += 1


def clean(raw: str) -> str:
    return " ".join(entities.unescape(raw).split())


def page_tokens(page: str) -> pd.DataFrame:
    """Tokens of a page for the template: token, how often, first place, letters of text, barred, what its path goes on from."""
    found: dict[str, list] = {}
    outer: dict[str, str] = {}
    for k, (kind, path, barred, raw) in enumerate(read_page(page, outer)):
        if kind == "gap":
            continue
        own = found.setdefault(path, [0, k, 0, barred])
        own[0] += kind == "open"
        if kind == "text" and raw.strip():
            text = clean(raw)
            own[2] += len(text)
            if not barred:
                mark = found.setdefault(f"{path}#{xxhash.xxh64_hexdigest(text)}", [0, k, len(text), False])
                mark[0] += 1
    rows = [(t, *v, outer.get(t.split("/", 1)[0])) for t, v in found.items()]
    return pd.DataFrame(rows, columns=["token", "times", "place", "letters", "barred", "outer"])


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def templates(pages: DataFrame) -> DataFrame:
    """One row per host: host, template (JSON: the main slot's path and constant text of the host)."""

    def tokens(batches):
        columns = ["host", "token", "times", "place", "letters", "barred", "outer", "vector"]
        for batch in batches:
            out, room = [], 0
            for host, key, page in zip(batch["host"], batch["page"], batch["html"]):
                own = page_tokens(page)
                own["vector"] = _signed([xxhash.xxh64_intdigest(f"{key}:{n}") for n in own["times"]])
                own["host"] = host
                out.append(own)
                room += len(own)
                if room > SENT_TOKENS:
                    yield pd.concat(out)[columns]
                    out, room = [], 0
            if out:
                yield pd.concat(out)[columns]

    schema = "host string, token string, times long, place long, letters long, barred boolean, outer string, vector long"
    seen = pages.select("host", F.xxhash64("page_id", "url").alias("page"), "html").mapInPandas(tokens, schema)
    vectors = seen.groupBy("host", "token").agg(
        # sums of hashes wrap around by parts, so that they never overflow
        F.sum(F.col("vector").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(F.shiftrightunsigned("vector", 32)).alias("high"),
        F.count("*").alias("pages"),
        F.min("times").alias("least"),
        F.max("times").alias("most"),
        F.avg("place").alias("place"),
        F.sum("letters").alias("letters"),
        F.bool_and("barred").alias("barred"),
        F.max("outer").alias("outer"),
    )
    sizes = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    common = vectors.join(sizes, "host").where((F.col("pages") >= SUPPORT * F.col("host_pages")) & (F.col("token") != ""))

    def deduce(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "template": [json.dumps(deduce_template(pdf))]})

    return common.groupBy("host").applyInPandas(deduce, "host string, template string")


def deduce_template(tokens: pd.DataFrame) -> dict:
    """Nest the classes of a host's common tokens; name the main slot and the constant text in it."""
    tokens = tokens.sort_values(["place", "token"])
    classes: dict[tuple, list] = {}
    for row in tokens.itertuples():
        classes.setdefault((row.low, row.high, row.pages), []).append(row)
    outer = {m.token.split("/", 1)[0]: m.outer for members in classes.values() for m in members if m.token.startswith("~")}
    paths = {m.token: (k, m.place) for k, members in classes.items() for m in members if "#" not in m.token and ">" not in m.token}
    up, children = {}, {}
    for path in paths:
        above = parent_of(path, outer)
        while above and above not in paths:
            above = parent_of(above, outer)
        up[path] = above
        children.setdefault(above, []).append(path)
    # down the tree and up again; per class the places of the elements now open
    broken, places, bottom_up = set(), {}, []
    todo = [(path, True) for path in children.get("", ())]
    while todo:
        path, enters = todo.pop()
        k, place = paths[path]
        line = places.setdefault(k, [])
        if not enters:
            line.pop()
            bottom_up.append(path)
            continue
        # one order: an element opens before what it encloses
        if line and line[-1] > place:
            broken.add(k)
        line.append(place)
        todo.append((path, False))
        todo += [(below, True) for below in children.get(path, ())]
    valid = [members for k, members in classes.items() if k not in broken]
    inside = {m.token: m for members in valid for m in members}
    slots = [m for t, m in inside.items() if "#" not in t and ">" not in t and not m.barred]
    constant = {t for t, m in inside.items() if "#" in t and m.host_pages >= 4 and m.least == m.most}
    fixed: dict[str, float] = {}
    for t in constant:
        path = t.split("#")[0]
        fixed[path] = fixed.get(path, 0) + inside[t].letters
    varying = lambda m: m.letters - fixed.get(m.token, 0)
    named = [m for m in slots if m.token.rsplit("/", 1)[-1].split(".")[0] in MAIN]
    if named:
        total = dict.fromkeys([*paths, ""], 0) | {m.token: varying(m) for m in slots}
        for path in bottom_up:
            total[up[path]] += total[path]
        best = max(named, key=lambda m: (total[m.token], m.token))
        return {"main": best.token, "drop": []}
    own = [m for m in slots if varying(m) > 0 and (m.token.startswith("~") or m.token.count("/") > 2)]
    if not own:
        return {"main": "", "drop": sorted(constant)}
    best = max(own, key=lambda m: (varying(m), m.token))
    inside_best = _inside(best.token, outer)
    return {"main": best.token, "drop": sorted(t for t in constant if inside_best(t.split("#")[0]))}


def _inside(slot: str, outer: dict[str, str]):
    """Tells whether a path lies in a slot."""
    known: dict[str, bool] = {}

    def lies(path: str) -> bool:
        chain = []
        while True:
            head = path.split("/", 1)[0]
            if path == slot or path.startswith(f"{slot}/"):
                found = True
            elif head in known:
                found = known[head]
            elif head in outer:
                chain.append(head)
                path = outer[head]
                continue
            else:
                found = False
            known.update(dict.fromkeys(chain, found))
            return found

    return lies


def main_text(page: str, template: dict) -> str:
    """The text of a page's main slot; its own article or main element where the template's is missing."""
    drop = set(template["drop"])
    where = template["main"]

    def within(slot: str) -> str:
        parts: list[str] = []
        outer: dict[str, str] = {}
        lies = _inside(slot, outer)
        for kind, path, barred, raw in read_page(page, outer):
            if kind == "gap":
                parts.append(" ")
            elif kind == "text" and not barred and lies(path):
                if not drop or f"{path}#{xxhash.xxh64_hexdigest(clean(raw))}" not in drop:
                    parts.append(raw)
        return clean("".join(parts))

    text = within(where) if where else ""
    if not text:
        paths = {path for kind, path, barred, _ in read_page(page) if kind == "open" and not barred}
        own = sorted(p for p in paths if p.rsplit("/", 1)[-1].split(".")[0] in MAIN)
        text = within(own[0]) if own else within("")
    return text


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))

    def texts(batches):
        known: dict[str, dict] = {}
        for batch in batches:
            found = []
            for page, template in zip(batch["html"], batch["template"]):
                if template not in known:
                    known[template] = json.loads(template) if template else {"main": "", "drop": []}
                found.append(main_text(page, known[template]))
            out = batch[["page_id", "url"]].assign(text=found)
            yield out.assign(n_chars=out["text"].map(len)).astype({"page_id": "Int64"})

    there = rows.join(templates(rows), "host", "left").select("page_id", "url", "html", "template")
    return there.mapInPandas(texts, "page_id long, url string, text string, n_chars long")
