"""Main text of web pages by deducing the template that pages of a host share.

A page is a sequence of tokens: the start and end tags of its elements, each named by the
path of open elements above it (with the class of a container), and its text nodes, named
by path and content. The occurrence vector of a token has one number per page of the host.
Tags and texts with equal vectors form an equivalence class if they are many, on enough
pages, in one order on every page (as often as they occur), and if no two classes overlap
other than by nesting. Members out of order and the smaller of two overlapping classes are
taken out.

The classes tell the roles of a token apart: in each gap between two members of a class
it is a token of its own, with its own vector. So classes are formed again, until no role
is split any more. Then each class lies in one gap of one other class or in none: the
template (``nested_classes``). Slots are the texts of one path in one gap.

Outside articles, a text is a template token if it is on nearly every page of the host
(but not where it plays a rare role beside that), or if it is one of at least ``MEMBERS``
texts of a class on enough pages, such as the menu of one section. In a slot whose texts
nearly all recur on enough pages, such as rotating adverts, these texts go too. Names of
elements and classes (menus, headers, footers, forms, adverts, comments) drop texts
besides; the class words give way on a host that would be left without own text.

On a page with an article or main element only slots below it remain, and whole: a
line that all articles share is still part of each. Other pages of the host keep
their slots.

Pages with equal markup count once. A host with a single page is judged with the
template of all hosts together. What a page holds beyond its template is kept, so a
slot seen on one page only is not lost.

Pages are parsed twice, once for their tokens and once for the text. The tokens are kept as
numbers in rows of many pages of a host; each round reads them with the host's classes
beside a row and adds up vectors, counts and places per role, so a hot host is spread. Only
tokens on a tenth of the host's pages take part: their number is bounded by the size of a
page. The template of a host is a small row that Spark sends along or joins by size.

Defined results: a null or empty page has an empty text; a null url is a host of its
own; repeated pages are extracted one by one; unclosed and stray tags are tolerated; a
page without any markup is its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import md5
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumelake.llm.common import written

FEW_PAGES = 8           # pages on which a text that is not on nearly all pages recurs
CONSTANT = 0.9          # share of pages on which a text is a template token
SUPPORT = 0.1           # share of pages on which a class is valid
MEMBERS = 3             # members of a class, and texts of one that is not on nearly all pages
CHUNK = 250             # pages of a host that are read together

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg math iframe object".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
             "p pre section summary table tbody td tfoot th thead title tr ul".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
# An element of the first kind is closed by a new one of the same group.
SIBLINGS = {tag: group for group in ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}) for tag in group}
ASIDE = set("head title nav header footer aside form button select textarea input label menu dialog".split()) | RAW
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer copyright cookie cookies consent notice alert popup "
    "modal newsletter subscribe signup login search share sharing social related recommended more widget widgets "
    "comment comments reply replies respond discussion disqus toolbar pagination pager tags meta".split())
CONTENT = {"article", "main"}

_TOKEN, _UNQUOTED = (re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    rf"<(/?)([A-Za-z][^\s/>]*)({attributes})>|[^<]+|<", re.S)
    for attributes in (r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*", "[^>]*"))
RAW_TEXT = RAW | {"textarea"}
_CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")


def _name(tag: str, attributes: str) -> str:
    """An element with the words of its class, id and role."""
    if not attributes or tag in ("html", "body"):
        return tag
    words = [w for m in _CLASS.findall(attributes) for w in "".join(m).lower().split()]
    return ".".join([tag, *dict.fromkeys(words)]) if words and tag in BLOCKS else tag


def _depth_of(stack: list[str], tags: set[str], stop: set[str]) -> int:
    """Place of the innermost open element of ``tags`` above any of ``stop``; -1 if none."""
    for n in range(len(stack) - 1, -1, -1):
        if stack[n] in tags:
            return n
        if stack[n] in stop:
            break
    return -1


_SCOPE = set("table td th ul ol dl button article main aside nav section div form footer header".split())
_LISTS = set("ul ol dl table select".split())


def parse(html: str | None) -> Iterator[tuple[str, str, str]]:
    """Tokens of a page: ("tag", path, "") for the start and the end of an element, and
    ("text", path, text) for the text of each block, in page order."""
    html = html or ""
    # Open elements, and for each the path of the blocks down to it.
    stack: list[str] = []
    paths: list[str] = [""]
    piece: list[str] = []
    place, at, size = "", 0, len(html)
    # No tag ends behind ``last``. After a quote that never ends, quotes no longer hide the
    # end of a tag. So a page of unclosed tags or quotes is read in one pass too.
    last, token = html.rfind(">"), _TOKEN

    def flush():
        text = _SPACE.sub(" ", unescape("".join(piece))).strip()
        piece.clear()
        return [("text", place, text)] if text else []

    def below(name):
        return f"{paths[-1]}/{name}" if paths[-1] else name

    def close(depth):
        ends = [("tag", f"{paths[n + 1]}/#end", "") for n in range(len(stack) - 1, depth - 1, -1) if stack[n] in BLOCKS]
        del stack[depth:], paths[depth + 1:]
        return ends

    while at < size:
        if html[at] == "<" and at > last and not html.startswith(("<!--", "<![CDATA["), at):
            if not piece:
                place = paths[-1]
            piece.append("<")
            at += 1
            continue
        m = token.match(html, at)
        if m.group() == "<" and token is _TOKEN and _UNQUOTED.match(html, at).group(2):
            token = _UNQUOTED
            m = token.match(html, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            body = m.group()
            if body.startswith(("<!", "<?")):
                if body.startswith("<![CDATA["):
                    piece.append(body[9:].removesuffix("]]>"))
                continue
            if not piece:
                place = paths[-1]
            piece.append(body)
            continue
        tag = tag.lower()
        closing, attributes = bool(m.group(1)), m.group(3)
        if not closing and tag in RAW_TEXT:
            yield "tag", below(tag), ""
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(html, at)
                at = end.end()
            continue
        block = tag in BLOCKS
        if block:
            yield from flush()
        elif tag == "br":
            piece.append(" ")
        if closing:
            depth = _depth_of(stack, {tag}, set())
            if depth >= 0:
                yield from close(depth)
            continue
        if tag in ENDS_PARAGRAPH:
            depth = _depth_of(stack, {"p"}, _SCOPE)
            if depth >= 0:
                yield from close(depth)
        if tag in SIBLINGS:
            depth = _depth_of(stack, SIBLINGS[tag], _LISTS | {"tr"} if tag in ("td", "th") else _LISTS)
            if depth >= 0:
                yield from close(depth)
        if block or tag in VOID:
            path = below(_name(tag, attributes))
            yield "tag", path, ""
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(tag)
            paths.append(path if block else paths[-1])
    yield from flush()


# Tokens and roles are numbers of 62 bits; those of texts are odd.
_MASK = (1 << 62) - 1
MET = 4096              # paths whose numbers a task keeps


def _number(path: str, text: str = "") -> int:
    number = int.from_bytes(md5(f"{path}\0{text}".encode("utf-8", "surrogatepass")).digest()[:8], "big") & _MASK
    return number | 1 if text else number & ~1


def _mixed(number: int, other: int, n: int) -> int:
    x = (number ^ (other + n * 0x1E3779B97F4A7C15)) * 0x3F58476D1CE4E5B9 & _MASK
    return x ^ x >> 31


def _numbered(steps: Iterable[tuple[str, str, str]], numbers: dict[str, int]) -> tuple[
        list[int], list[str], list[int]]:
    """The tokens of a page as numbers, the path of each, and the places of its texts. A text
    is two tokens, its slot and its content. ``numbers``: those of paths met before."""
    tokens, paths, places = [], [], []
    for kind, path, text in steps:
        slot = path if kind == "tag" else f"{path}/#text"
        number = numbers.get(slot)
        if number is None:
            number = numbers[slot] = _number(slot)
        tokens.append(number)
        paths.append(slot)
        if kind != "tag":
            places.append(len(tokens))
            tokens.append(_number(slot, text))
            paths.append(slot)
    return tokens, paths, places


_PAGES = "page long, host string, part int, paths array<string>, tokens array<long>, of array<int>"
_CHUNKS = "host string, pages array<long>, sizes array<int>, paths array<string>, tokens array<long>, of array<int>"
_TOKENS = "host string, path string, text string, token long, vector long, pages long, n long, places long"


def _frame(rows: list, schema: str) -> pd.DataFrame:
    # Numbers beside nulls must not become floats.
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)


def _sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per page with tokens: their numbers, its distinct paths, and the path of each."""
    for batch in batches:
        rows, numbers = [], {}
        for page, host, part, html in zip(batch["page"], batch["host"], batch["part"], batch["html"]):
            if len(numbers) > MET:
                numbers.clear()
            tokens, paths, _ = _numbered(parse(html), numbers)
            if tokens:
                names = {path: n for n, path in enumerate(dict.fromkeys(paths))}
                rows.append((page, host, part, list(names), tokens, [names[p] for p in paths]))
        yield _frame(rows, _PAGES)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pages of a batch, those of a host in one row."""
    for batch in batches:
        rows = []
        for host, group in batch.groupby("host", sort=False):
            names: dict[str, int] = {}
            tokens, of = [], []
            for paths, numbers, places in zip(group["paths"], group["tokens"], group["of"]):
                known = [names.setdefault(path, len(names)) for path in paths]
                tokens += numbers if isinstance(numbers, list) else numbers.tolist()
                of += [known[n] for n in places]
            rows.append((host, group["page"].tolist(), [len(t) for t in group["tokens"]], list(names), tokens, of))
        yield _frame(rows, _CHUNKS)


def _folded_counts(pages: Iterator[tuple[int, list]]) -> dict:
    """Per key: its folded occurrence vector, pages, occurrences and the sum of its places.
    ``pages``: the number of a page and the key of each token, None for none."""
    found: dict = {}
    for page, keys in pages:
        seen: dict = {}
        for place, key in enumerate(keys):
            if key is not None:
                entry = seen.get(key)
                if entry is None:
                    seen[key] = [1, place]
                else:
                    entry[0] += 1
                    entry[1] += place
        for key, (n, places) in seen.items():
            vector, total = _mixed(page & _MASK, 0, n), found.get(key)
            if total is None:
                found[key] = [vector, 1, n, places]
            else:
                total[0] ^= vector
                total[1] += 1
                total[2] += n
                total[3] += places
    return found


def _cut(pages, sizes, tokens) -> Iterator[tuple[int, list]]:
    start, numbers = 0, tokens if isinstance(tokens, list) else tokens.tolist()
    for page, size in zip(pages, sizes):
        yield int(page), numbers[start:start + size]
        start += size


def _count_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk and token its folded counts. Only texts have a content."""
    for batch in batches:
        rows = []
        for host, pages, sizes, paths, tokens, of in zip(*(batch[c.split()[0]] for c in _CHUNKS.split(", "))):
            path = dict(zip(tokens if isinstance(tokens, list) else tokens.tolist(), of))
            rows += [(host, paths[path[token]], str(token) if token & 1 else "", token, *counts)
                     for token, counts in _folded_counts(_cut(pages, sizes, tokens)).items()]
        yield _frame(rows, _TOKENS)


def _count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same for distinct pages as they are: page, host, html."""
    return _count_chunks(_chunks(_sequences(batch.assign(part=0) for batch in batches)))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


_FOLDED = {"vector": F.bit_xor, "pages": F.sum, "n": F.sum, "places": F.sum}


def token_classes(tokens: DataFrame) -> DataFrame:
    """Per host and token: its folded occurrence vector, pages, occurrences and the sum of
    its places. A page must be there once."""
    return _folded(tokens, "host", "path", "text", "token")


def _folded(parts: DataFrame, *by: str) -> DataFrame:
    return parts.groupBy(*by).agg(*[f(c).alias(c) for c, f in _FOLDED.items()])


Template = list[dict[int, tuple[int, int, int]]]


def _levels(members, ids, sizes, rounds) -> Template:
    """The classes of each round: per member the class, its place there, and the size."""
    levels: Template = []
    start, members = 0, [int(m) for m in members]
    for cls, size, level in zip(ids, sizes, rounds):
        levels += [{} for _ in range(int(level) + 1 - len(levels))]
        for at in range(size):
            levels[level][members[start + at]] = (int(cls), at, int(size))
        start += size
    return levels


def _gaps(roles: list[int], members: dict[int, tuple[int, int, int]]) -> list[tuple[int, int] | None]:
    """Per token the innermost open class around it and the last member of that before it."""
    out: list[tuple[int, int] | None] = []
    stack: list[tuple[int, int]] = []
    for role in roles:
        member = members.get(role)
        if member:
            cls, at, size = member
            # A page that the template was not deduced from may lack the members before.
            depth = next((n for n in range(len(stack) - 1, -1, -1) if stack[n][0] == cls), -1) if at else len(stack)
            if depth >= 0:
                del stack[depth:]
                out.append(stack[-1] if stack else None)
                if at < size - 1:
                    stack.append((cls, at))
                continue
        out.append(stack[-1] if stack else None)
    return out


def _split(roles: list[int], gaps: list[tuple[int, int] | None]) -> list[int]:
    """Roles told apart by their gap."""
    return [_mixed(role, *gap) if gap else role for role, gap in zip(roles, gaps)]


def _roles(tokens: list[int], levels: Template) -> list[int]:
    for members in levels:
        tokens = _split(tokens, _gaps(tokens, members))
    return tokens


def _invalid(roles: list[int], members: dict[int, tuple[int, int, int]]) -> set[tuple[int, int]]:
    """Members out of order on a page, as (class, place); (class, -1) for the smaller of two
    classes that overlap without being nested."""
    seen: dict[int, int] = {}
    order: dict[int, list[int]] = {}
    for role in roles:
        if role in members:
            cls, at, size = members[role]
            n = seen.get(role, 0)
            seen[role] = n + 1
            order.setdefault(cls, []).append(n * size + at)
    size_of = {cls: size for cls, _, size in members.values()}
    bad = set()
    for cls, keys in order.items():
        if keys == list(range(len(keys))) and len(keys) % size_of[cls] == 0:
            continue
        # A member in an inversion has a larger one before it or a smaller one behind it.
        size, high, low = size_of[cls], -1, len(keys) * size_of[cls]
        wrong = set()
        for key in keys:
            high = max(high, key)
            if key < high:
                wrong.add(key % size)
        for key in reversed(keys):
            low = min(low, key)
            if key > low:
                wrong.add(key % size)
        bad |= {(cls, at) for at in wrong or range(size)}
    broken = {cls for cls, _ in bad}
    stack: list[int] = []
    for role in roles:
        if role not in members or members[role][0] in broken:
            continue
        cls, at, size = members[role]
        if at == 0:
            stack.append(cls)
            continue
        while stack and stack[-1] != cls and cls in stack:
            bad.add((min(cls, stack.pop(), key=lambda c: (size_of[c], c)), -1))
        if at == size - 1 and stack and stack[-1] == cls:
            stack.pop()
    return bad


_SCAN = "host string, old long, role long, cls long, at long, vector long, pages long, n long, places long"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk and role of the last round: the gaps of the classes of this round it is
    found in, the role it plays there, and its folded counts. If the classes are not valid
    on all pages of the chunk, rows of what is wrong with them, without a role."""
    for batch in batches:
        rows = []
        for host, pages, sizes, tokens, known, bases, *classes in zip(*(batch[c] for c in _SCANNED)):
            *classes, level = classes
            levels = _levels(*classes)
            levels += [{} for _ in range(int(level) + 1 - len(levels))]
            *levels, members = levels
            known, bases, bad = set(known.tolist()), set(bases.tolist()), set()

            def keys():
                for page, numbers in _cut(pages, sizes, tokens):
                    roles = _roles([t for t in numbers if t in bases], levels)
                    bad.update(_invalid(roles, members))
                    yield page, [(role, gap) if role in known else None
                                 for role, gap in zip(roles, _gaps(roles, members))] if not bad else []

            found = _folded_counts(keys())
            if bad:
                rows += [(host, None, None, cls, at, None, None, None, None) for cls, at in bad]
            else:
                rows += [(host, role, *_split([role], [gap]), *(gap or (None, None)), *counts)
                         for (role, gap), counts in found.items()]
        yield _frame(rows, _SCAN)


_SCANNED = ["host", "pages", "sizes", "tokens", "known", "bases", "members", "ids", "lengths", "rounds", "round"]


def _parts(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "/?#text$", ""), "/")


def _aside(path: Column, names: bool = True) -> Column:
    """A path with an element or class that is not part of the article."""
    parts = _parts(path)
    inside = F.array_position(F.transform(parts, lambda p: F.split(p, r"\.")[0].isin(*CONTENT)), F.lit(True))

    def bad(p, i):
        words = F.split(p, r"\.")
        tag = F.element_at(words, 1)
        # The header and title of an article belong to it.
        own = (inside > 0) & (i + 1 > inside) & tag.isin("header", "title", "label")
        named = F.arrays_overlap(F.slice(words, 2, F.size(words)), F.array(*[F.lit(w) for w in sorted(ASIDE_NAMES)]))
        return (tag.isin(*sorted(ASIDE)) & ~own) | (F.lit(names) & named & ~tag.isin(*CONTENT))
    return F.exists(F.transform(parts, bad), lambda x: x)


def _content(path: Column) -> Column:
    return F.exists(F.split(path, "/"), lambda p: F.split(p, r"\.")[0].isin(*CONTENT))


ALL = "/"               # stands for all hosts together, as no host has a slash


def _compact(classes: DataFrame) -> DataFrame:
    """A row per host: the members of its classes one after the other, and per class its
    number, its size and its round."""
    found = F.sort_array(F.collect_list(F.struct("level", "cls", "members")))
    return classes.groupBy("host").agg(found.alias("_c")).select(
        "host", F.flatten(F.transform("_c", lambda c: c["members"])).alias("members"),
        F.transform("_c", lambda c: c["cls"]).alias("ids"),
        F.transform("_c", lambda c: F.size(c["members"])).alias("lengths"),
        F.transform("_c", lambda c: c["level"]).alias("rounds"))


def _formed(roles: DataFrame, level: int) -> DataFrame:
    """Candidates for classes: tags and texts on enough pages with equal vectors, in the order
    of the sums of their places, which is theirs on every page if they have one."""
    tokens = roles.where(~F.endswith("path", F.lit("#text")) | (F.col("text") != "")).where(
        _often("pages") | _nearly_all("pages"))
    found = F.transform(F.sort_array(F.collect_list(F.struct("places", "role"))), lambda m: m["role"])
    cls = F.shiftrightunsigned(F.xxhash64("host", "vector", "pages", "n", F.lit(level)), 2)
    return tokens.groupBy("host", "vector", "pages", "n").agg(found.alias("members")).where(
        F.size("members") >= MEMBERS).select("host", F.lit(level).alias("level"), cls.alias("cls"), "members")


def _often(pages: str) -> Column:
    return F.col(pages) >= F.greatest(SUPPORT * F.col("size"), F.lit(FEW_PAGES))


def _nearly_all(pages: str) -> Column:
    least = F.when(F.col("host") == ALL, F.lit(FEW_PAGES)).otherwise(2)
    return F.col(pages) >= F.greatest(CONSTANT * F.col("size"), least)


_ROLE = ["host", "size", "path", "text", "base", "base_pages", "old", "role", "cls", "at", *_FOLDED]


def differentiated(chunks: DataFrame, roles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forms classes and tells roles apart by them, in turn, until no role is split. Hosts
    whose classes are not valid yet try again without the members at fault; hosts that are
    done leave. Returns the roles with their gap (``cls``, ``at``) and the classes of every
    round; the classes of the last one, ``level``, are valid and split nothing."""
    roles = written(roles.withColumns({
        "base": F.col("token"), "base_pages": F.col("pages"), "old": F.col("token"), "role": F.col("token"),
        "cls": F.lit(None).cast("long"), "at": F.lit(None).cast("long")}).select(
        *_ROLE, F.lit(-1).alias("level")), "template-roles")
    classes = written(_formed(roles, 0), "template-classes")
    bases = written(roles.groupBy("host").agg(F.collect_set("base").alias("bases")), "template-bases")
    level = 0
    while True:
        active = roles.where(F.col("level") < 0)
        if active.isEmpty():
            return roles, classes
        state = active.groupBy("host").agg(F.collect_set("role").alias("known")).join(bases, "host").join(
            _compact(classes), "host", "left").withColumn("round", F.lit(level))
        empty = F.array().cast("array<long>")
        state = state.withColumns({c: F.coalesce(c, empty.cast(state.schema[c].dataType)) for c in
                                   ("members", "ids", "lengths", "rounds")})
        scanned = chunks.select("host", "pages", "sizes", "tokens").join(state, "host").select(*_SCANNED)
        scanned = written(_folded(scanned.mapInPandas(_scan, _SCAN), "host", "old", "role", "cls", "at"), "template-scan")
        wrong = scanned.where(F.col("role").isNull()).select("host", "cls", "at")
        again = wrong.select("host")
        told = scanned.where(F.col("role").isNotNull()).join(again, "host", "left_anti").join(
            active.select("host", "size", "path", "text", "base", "base_pages", F.col("role").alias("old")), ["host", "old"])
        told = written(told.select(*_ROLE), "template-told")
        split = told.groupBy("host", "old").agg(F.count(F.lit(1)).alias("roles")).where(F.col("roles") > 1).select("host")
        # A role on a single page recurs nowhere.
        fresh = told.join(split, "host", "left_semi").where(F.col("pages") > 1).withColumn("level", F.lit(-1))
        same = told.join(split, "host", "left_anti").withColumn("level", F.lit(level))
        roles = written(roles.where(F.col("level") >= 0).unionByName(active.join(again, "host", "left_semi")).unionByName(
            same).unionByName(fresh), "template-roles")
        # Classes at fault without those members; new ones where roles are split.
        tried = classes.where(F.col("level") == level).join(
            wrong.groupBy("host", "cls").agg(F.collect_set("at").alias("_bad")), ["host", "cls"], "left").join(
            again, "host", "left_semi")
        rest = F.when(F.col("_bad").isNull(), F.col("members")).when(
            ~F.array_contains("_bad", F.lit(-1).cast("long")), F.filter(
                "members", lambda _, n: ~F.array_contains("_bad", n.cast("long"))))
        tried = tried.select("host", F.lit(level + 1).alias("level"), "cls", rest.alias("members")).where(
            F.size("members") >= MEMBERS)
        before = classes.where(F.col("level") < level).unionByName(
            classes.where(F.col("level") == level).join(again, "host", "left_anti"))
        new = roles.where(F.col("level") < 0).join(again, "host", "left_anti")
        level += 1
        classes = written(before.unionByName(tried).unionByName(_formed(new, level)), "template-classes")


def nested_classes(roles: DataFrame, classes: DataFrame) -> DataFrame:
    """The template of a host: its classes, each with the class and the gap it lies in."""
    last = classes.join(roles.where(F.col("level") >= 0), ["host", "level"], "left_semi")
    first = roles.select("host", F.col("old").alias("_first"), F.col("cls").alias("parent"), F.col("at").alias("gap"))
    return last.withColumn("_first", F.col("members")[0]).join(first, ["host", "_first"], "left").select(
        "host", "cls", "members", "parent", "gap")


def deduce(pages: DataFrame) -> DataFrame:
    """The template of each host with two pages, in a row: its classes (``members``, ``ids``,
    ``lengths``, ``rounds``, see ``_compact``) and how they are nested (``nested``), the roles
    of recurring texts of slots that are part of it (``dropped``), the paths that stay
    whatever their class words (``kept``), and constant texts, by role or token
    (``constant``). ``pages``: host, html. If a host has a single page, the row of host
    ``ALL`` holds for all hosts together."""
    # Few hosts have more pages than a chunk; their pages are dealt out.
    hot = pages.groupBy(F.col("host").alias("_h")).agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts")).where("parts > 1")
    keyed = pages.select(F.xxhash64("html", "host").alias("page"), "host", "html").join(
        F.broadcast(hot), F.col("host") == F.col("_h"), "left").withColumn(
        "part", F.coalesce(F.pmod("page", "parts"), F.lit(0)).cast("int"))
    # Equal pages have equal tokens.
    chunks = written(keyed.select("page", "host", "part", "html").mapInPandas(_sequences, _PAGES).repartition(
        "host", "part").dropDuplicates(["host", "part", "page"]).sortWithinPartitions(
        "host").mapInPandas(_chunks, _CHUNKS), "template-chunks")
    tokens = written(token_classes(chunks.mapInPandas(_count_chunks, _TOKENS)), "template-tokens")
    sizes = chunks.groupBy("host").agg(F.sum(F.size("pages")).alias("size"))
    # A text on one page of its host is no template token of the host.
    known = tokens.where(F.col("pages") > 1)
    if not sizes.where(F.col("size") == 1).isEmpty():
        everywhere = _folded(tokens, "path", "text", "token").withColumn("host", F.lit(ALL))
        known = known.unionByName(everywhere)
        sizes = sizes.unionByName(sizes.select(F.lit(ALL).alias("host"), F.sum("size").alias("size")))
        chunks = chunks.unionByName(chunks.withColumn("host", F.lit(ALL)))
    sizes = sizes.where(F.col("size") > 1)
    known = written(known.join(sizes, "host").where(
        F.col("pages") >= F.greatest(F.lit(2), SUPPORT * F.col("size"))), "template-known")
    roles, classes = differentiated(chunks, known)
    nested = nested_classes(roles, classes)
    roles = roles.where(~_content(F.col("path")))
    texts = roles.where(F.col("text") != "")
    # Texts of a class on enough pages with enough texts, or on nearly all pages. A rare role
    # of the latter is no template token, if another is on nearly all pages by itself.
    member = nested.select("host", F.col("cls").alias("own"), F.explode("members").alias("old"))
    valid = texts.where(_often("pages")).join(member, ["host", "old"]).groupBy("host", "own").agg(
        F.collect_set("role").alias("roles")).where(F.size("roles") >= MEMBERS)
    alone = texts.where(_nearly_all("base_pages")).withColumn("_one", F.max(_nearly_all("pages")).over(
        Window.partitionBy("host", "base"))).where(~F.col("_one") | _often("pages") | _nearly_all("pages"))
    fixed = valid.select("host", F.explode("roles").alias("role")).unionByName(alone.select(
        "host", F.when(F.col("_one"), F.col("role")).otherwise(F.col("base")).alias("role"))).groupBy("host").agg(
        F.collect_set("role").alias("constant"))
    # Slots: how much of them recurs.
    often = (F.col("text") != "") & _often("base_pages")
    recurring = F.sum(F.when(often, F.col("n")).otherwise(0)).alias("recurring")
    total = F.sum(F.when(F.col("text") == "", F.col("n"))).alias("total")
    part = F.col("recurring") >= CONSTANT * F.col("total")
    dropped = roles.where(F.endswith("path", F.lit("#text"))).groupBy("host", "cls", "at", "path").agg(
        total, recurring, F.collect_set(F.when(often, F.col("role"))).alias("roles")).where(part).groupBy("host").agg(
        F.flatten(F.collect_list("roles")).alias("dropped"))
    # Paths of texts that do not recur.
    plain = known.where(F.endswith("path", F.lit("#text")) & ~_content(F.col("path"))).withColumn(
        "base_pages", F.col("pages")).groupBy("host", "path").agg(total, recurring, F.max(
            F.when(F.col("text") == "", F.col("pages")) / F.col("size")).alias("share")).where(
        F.col("total").isNotNull() & (F.col("host") != ALL)).withColumns({
            "tag": _aside(F.col("path"), False), "named": _aside(F.col("path"))})
    own = ~part & (F.col("share") >= SUPPORT)
    kept = plain.groupBy("host").agg(
        F.collect_set(F.when(own & ~F.col("tag"), F.col("path"))).alias("kept"),
        F.max(own & ~F.col("named")).alias("_free"))
    # Class words give way only where nothing is free of them.
    kept = kept.select("host", F.when(F.col("_free"), F.array().cast("array<string>")).otherwise(F.col("kept")).alias("kept"))
    tree = nested.groupBy("host").agg(F.collect_list(F.struct("cls", "parent", "gap")).alias("nested"))
    found = sizes.select("host")
    for columns in (dropped, kept, fixed, tree, _compact(classes)):
        found = found.join(columns, "host", "left")
    return found
def _aside_path(path: str) -> bool:
    """The role of a path that no template knows."""
    inside = False
    for part in path.split("/"):
        tag, *names = part.split(".")
        own = inside and tag in ("header", "title", "label")
        if (tag in ASIDE and not own) or (tag not in CONTENT and not ASIDE_NAMES.isdisjoint(names)):
            return True
        inside = inside or tag in CONTENT
    return False


def _has_content(path: str) -> bool:
    return any(p.split(".", 1)[0] in CONTENT for p in path.split("/"))


def _extract(html: str | None, dropped: set, kept: set[str], constant: set, levels: Template = ()) -> str:
    steps = list(parse(html))
    blocks = [(path, text) for kind, path, text in steps if kind == "text"]
    article = any(_has_content(path) and not _aside_path(path) for path, _ in blocks)
    tokens = roles = places = None
    if not article and (dropped or constant):
        tokens, _, places = _numbered(steps, {})
        roles = _roles(tokens, levels)
    out = []
    for n, (path, text) in enumerate(blocks):
        inside = _has_content(path)
        if article and not inside or _aside_path(path) and f"{path}/#text" not in kept:
            continue
        if roles and not inside:
            role, token = roles[places[n]], tokens[places[n]]
            if role in constant or token in constant or role in dropped:
                continue
        out.append(text)
    return "\n".join(out)


_TEMPLATE = ["dropped", "kept", "constant", "members", "ids", "lengths", "rounds"]


def _known_template(columns) -> list:
    """Sets of what is dropped, kept and constant, and the levels of a template's row."""
    dropped, kept, constant, *classes = [x if x is not None else () for x in columns]
    return [{int(x) for x in dropped}, set(kept), {int(x) for x in constant}, _levels(*classes)]


def main_text(pages: DataFrame, html: str = "html", url: str = "url", id_col: str = "page_id") -> DataFrame:
    """A row per page: the id, the url, ``text`` and ``n_chars``."""
    rows = pages.select(F.col(id_col).alias("page"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
                        F.col(html).alias("html"))
    templates = written(deduce(rows.select("host", "html")), "templates")
    shared = templates.where(F.col("host") == ALL).first()        # one row
    every = _known_template([shared[c] for c in _TEMPLATE] if shared else [None] * len(_TEMPLATE))
    own = templates.where(F.col("host") != ALL).select(F.col("host").alias("_host"), *_TEMPLATE)

    @F.pandas_udf("string")
    def extracted(html: pd.Series, host: pd.Series, dropped: pd.Series, kept: pd.Series, constant: pd.Series,
                  members: pd.Series, ids: pd.Series, lengths: pd.Series, rounds: pd.Series) -> pd.Series:
        out, known = [], {}
        for page, h, *template in zip(html, host, dropped, kept, constant, members, ids, lengths, rounds):
            if h is not None and h not in known:
                known[h] = _known_template(template)
            out.append(_extract(page, *(known[h] if h is not None else every)))
        return pd.Series(out, dtype=object)

    joined = rows.join(own, F.col("host") == F.col("_host"), "left")
    text = extracted("html", "_host", *_TEMPLATE)
    return joined.select(F.col("page").alias(id_col), F.col("url").alias(url), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
