"""Main text of web pages by tag-path ratios (operator 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellwatt.llm.common import pieces, table

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no article text, and names by which pages mark such parts.
OUTSIDE = frozenset(
    "head title nav footer aside form button select option textarea input dialog menu iframe object canvas audio video "
    "noscript template svg math datalist fieldset map".split()
)
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors promo promos promotion "
    "promotions banner banners nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs crumbs footer foot header "
    "masthead topbar sidebar sidebars side rail aside widget widgets cookie cookies consent gdpr notice notices notification "
    "notifications alert alerts disclaimer popup popups modal overlay toast comment comments commentlist reply replies respond "
    "disqus discussion share sharing social related recommended recommendations newsletter subscribe subscription signup "
    "login signin search searchbox pagination pager skip toolbar copyright legal".split()
)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
INSIDE = frozenset(("article", "main"))
INSIDE_NAMES = frozenset("article content main post entry story body text".split())
PUNCTUATION = frozenset(".,;:!?…。，、¿¡")
#: An element's start tag also ends these, if one is open below the boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Any other block ends an open paragraph.
PARAGRAPHS = ({"p"}, {"article", "section", "div", "td", "table", "button"})
#: Share of the best path's ratio that a path must reach.
THRESHOLD = 0.2
#: First words by which a name tells of a part rather than marks it, as in has-sidebar.
TELLING = frozenset("no not without hide hidden has have with is show".split())
#: Elements whose names tell what they are about, not what part of the page they are.
TITLES = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: Last words of names that hold such a part, as in comment-list or ad-container.
HOLDERS = frozenset(
    "list section body area inner outer posts articles stories news bar box container wrapper wrap block item items content text "
    "links link row col column panel group unit slot zone region title thread author module holder entry message post main".split()
)
#: Parts that an article has too: article-header is one of its own.
OWN = frozenset("header head footer foot masthead".split())
#: What each step that a name or a form marks leaves of a path's ratio.
LOWERED = 0.05


def extractor():
    """A function from a page to its main text."""
    import heapq
    import html
    import re

    token = re.compile(
        r"<!--.*?(?:-->|\Z)"
        r"|<(script|style|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
        r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*(?:\"[^\"]*\"|'[^']*')?|[\"'])*+)(?:>|\Z)"
        r"|<[!?/][^>]*(?:>|\Z)",
        re.S | re.I,
    )
    attribute = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
    word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

    def marks(name: str) -> bool:
        """Whether one name of a class or id marks a part outside the article, or what holds one."""
        parts = [w.lower() for w in word.findall(name)]
        at = next((k for k, w in enumerate(parts) if w in OUTSIDE_NAMES), None)
        if at is None or parts[0] in TELLING or parts[at] in OWN and INSIDE_NAMES & set(parts[:at]):
            return False
        return parts[-1] in OUTSIDE_NAMES or parts[-1] in HOLDERS

    def standing(tag: str, attributes: str, inside: bool) -> tuple[str, bool, bool, bool]:
        """An element's step in a path, whether it is out of the article, probably out by name, or a part of it by name."""
        if tag == "header":
            return tag, not inside, False, False
        if not attributes:
            return tag, tag in OUTSIDE and tag != "form", tag == "form", tag in INSIDE
        names, out, soft, hint = [], tag in OUTSIDE and tag != "form", tag == "form", tag in INSIDE
        for key, *values in attribute.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id"):
                names.append(value)
                for name in value.split():
                    if marks(name):
                        soft = soft or tag not in TITLES
                    else:
                        hint = hint or any(w.lower() in INSIDE_NAMES for w in word.findall(name))
            elif key == "role":
                out = out or value.lower() in OUTSIDE_ROLES
                hint = hint or value.lower() in INSIDE
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                out = True
            elif key == "style" and "display:none" in value.replace(" ", "").lower():
                out = True
        out = out and tag not in ("html", "body", "article", "main")
        soft = soft and tag not in ("html", "body", "article", "main")
        if tag in INLINE:
            out, soft = out or soft, False
        return ".".join([tag, *sorted(names)]), out, soft, hint

    def blocks(page: str):
        """Paths as (parent, last step, marked steps, named as content), and the blocks as (path, text, letters in links)."""
        paths, known = [(-1, "", 0, False)], {}
        stack: list[tuple] = []  # tag, whether outside, path, path of what is around
        places: dict[str, list[int]] = {}  # where each tag is open
        found, texts, linked, out, here = [], [], 0, 0, 0

        def close() -> None:
            nonlocal texts, linked
            if texts:
                text = " ".join(html.unescape("".join(texts)).split())
                if text:
                    found.append((here, text, min(linked, len(text))))
            texts, linked = [], 0

        def pop(to: int) -> None:
            nonlocal out, here
            if any(e[0] not in INLINE for e in stack[to:]):
                close()
            while len(stack) > to:
                tag, outside, here = stack.pop()
                places[tag].pop()
                out -= outside

        def hold(text: str) -> None:
            nonlocal linked
            if text and not out:
                texts.append(text)
                if places.get("a"):
                    linked += len(text)

        def last(tags) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=-1)

        at = 0
        for match in token.finditer(page):
            hold(page[at:match.start()])
            at = match.end()
            tag = match.group(3)
            if tag is None:
                continue
            tag = tag.lower()
            if match.group(2):
                if places.get(tag):
                    pop(places[tag][-1])
                elif tag not in INLINE:
                    close()
                continue
            if tag not in INLINE:
                close()
                ended, bounds = ENDS.get(tag, PARAGRAPHS)
                place = last(ended)
                if place > last(bounds):
                    pop(place)
            elif tag == "br":
                hold(" ")
            if tag not in VOID:
                step, outside, marked, named = standing(tag, match.group(4), last(INSIDE) >= 0 if tag == "header" else False)
                stack.append((tag, outside, here))
                places.setdefault(tag, []).append(len(stack) - 1)
                out += outside
                if tag not in INLINE:
                    key = here, step, marked, named
                    if key not in known:
                        known[key] = len(paths)
                        paths.append((here, step, paths[here][2] + marked, paths[here][3] or named))
                    here = known[key]
                elif named and not paths[here][3]:
                    key = here, "", False, True
                    if key not in known:
                        known[key] = len(paths)
                        paths.append((here, "", paths[here][2], True))
                    here = known[key]
        hold(page[at:])
        close()
        return paths, found

    def ratios(paths, found) -> dict[int, float]:
        """For every path with blocks, text and punctuation per block, smoothed along the page and fused with the names."""
        sums: dict[int, list] = {}
        for path, text, linked in found:
            s = sums.setdefault(path, [0, 0, 0, 0])
            s[0] += 1
            s[1] += len(text)
            s[2] += sum(map(text.count, PUNCTUATION))
            s[3] += linked
        plain = [
            (letters / count) ** 0.5 * (1 + points / count) ** 0.5 * (1 - linked / letters)
            for count, letters, points, linked in sums.values()
        ]
        padded = [plain[0], *plain, plain[-1]]
        fewest = min(paths[path][2] for path in sums)
        made = {}
        for path, a, b, c in zip(sums, padded, padded[1:], padded[2:]):
            _, _, marked, named = paths[path]
            smooth = 0.25 * a + 0.5 * b + 0.25 * c if b or named else 0.0
            made[path] = smooth * (3 if named and marked == fewest else 1) * LOWERED ** (marked - fewest)
        return made

    def shared(paths, some) -> int:
        """The longest path that all of these go on from."""
        some = set(some)
        # A path's number is larger than that of what it goes on from.
        heap = [-p for p in some]
        heapq.heapify(heap)
        while len(some) > 1:
            path = -heapq.heappop(heap)
            some.discard(path)
            parent = paths[path][0]
            if parent not in some:
                some.add(parent)
                heapq.heappush(heap, -parent)
        return some.pop()

    def extract(page: str | None) -> str:
        paths, found = blocks(page or "")
        if not found:
            return ""
        ratio = ratios(paths, found)
        least = THRESHOLD * max(ratio.values())
        chosen = {path for path, r in ratio.items() if r >= least}
        fewest = min(paths[path][2] for path in ratio)
        named = {path for path in chosen if paths[path][3] and paths[path][2] == fewest}
        # What the best paths have in common is the article; all in it belongs to it but for what names mark.
        root = shared(paths, named or chosen)
        tag = paths[root][1].split(".")[0]
        if named or tag not in ("", "html", "body"):
            inside = [False] * len(paths)
            for path, (parent, _, marked, _) in enumerate(paths):
                below = path == root or path > root and parent >= 0 and inside[parent]
                inside[path] = below
            kept = {path for path in ratio if inside[path] and (path in chosen or paths[path][2] == paths[root][2])}
            if tag in ("", "html", "body"):
                kept &= chosen
        else:
            kept = {path for path in ratio if path in chosen or paths[path][1].split(".")[0] in ("h1", "h2", "h3")}
        return "\n".join(text for path, text, _ in found if path in kept)

    return extract


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text``, the article of each page's whole html.

    A page is cut into blocks, runs of text between block elements, each under its
    path of tags with their class and id names. Per path, the letters and the
    punctuation of a block are averaged, taken with the share of text outside links,
    smoothed along the page and fused with what the names say; paths below a share of
    the best are dropped. What the remaining paths, those named as content first, have
    in common is the article, and every block in it is kept but those that names mark
    and whose paths were dropped. Parts that tags or roles mark as menus, headers,
    footers, sidebars or notices take no part at any step, nor do scripts and styles. Forms,
    and parts that a class or id name marks, only have their path's ratio lowered, so
    a page that lies in such a part as a whole is read like any other.

    Character references are decoded, white space within a block becomes one space,
    and blocks are joined by line feeds. Null and empty pages, and pages without such
    text, give an empty text. Pages are judged one by one, so neither a common host
    nor repeated rows matter; broken markup is read as browsers do in the main cases.
    """

    def run(batches):
        import pyarrow as pa

        extract = extractor()
        for part in pieces(batches):
            made = [extract(page) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op8_pages(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(table(spark, sf, "pages"))


QUERIES = {"op8_pages": (op8_pages, None)}
