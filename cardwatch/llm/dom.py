"""A page as a flat list of block elements and text pieces, with features of each element. Small, Spark-free helper."""

from __future__ import annotations

import html
import math
import random
import re

# Elements of the HTML standard, by how they are laid out and closed.
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
            "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
            "section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe noembed noframes xmp textarea title svg object canvas audio video button select datalist annotation "
          "annotation-xml".split())
HARD = set("script style iframe noembed noframes xmp textarea title".split())  # hold no markup
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead"},
          "tfoot": {"tr", "td", "th", "tbody"}}
HOLDS = set("ul ol dl table select article aside section div nav body html td th".split())
CONTROLS = set("input select textarea button option label".split())
# Words of tags and attributes that speak for and against the main text.
FOR = set("article main content post entry story body text articlebody maincontent".split())
AGAINST = set("nav navigation navbar menu header masthead footer sidebar aside ad ads advert advertisement adverts sponsor "
              "sponsored promo banner cookie cookies consent gdpr notice alert comment comments reply replies discussion share "
              "sharing social related recommended newsletter subscribe signup login form search breadcrumb breadcrumbs "
              "pagination pager widget popup modal overlay copyright disclaimer toolbar tags meta complementary "
              "contentinfo dialog".split())
# Words of names that say where something is or what shape it has, and small words of labels.
LAYOUT = set("site page top bottom left right side inner outer block box bar list item items link links section container "
             "wrapper wrap area region group row column panel button buttons icon icons zone global local primary secondary "
             "articles posts stories this the our your us to on of for".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|data-role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SELF_CLOSED = re.compile(r"(?<!=)(?:^|[\s\"']|\s[^\s=\"']+)/\Z")
_WORD = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?,;:]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_INSIDE = re.compile(r"<(article|main)\b[^>]*>(.*)</\1\s*>", re.S | re.I)
_PARAGRAPH = re.compile(r"<p\b[^>]*>([^<]{20,600})")
_FORMS = ("<ul><li>{}</li><li>{}</li></ul>", "<ol><li>{}</li><li>{}</li></ol>", "<blockquote>{}</blockquote>",
          "<blockquote><p>{}</p></blockquote>", "<table><tr><td>{}</td><td>{}</td></tr></table>", "<h2>{}</h2><p>{}</p>", "<h3>{}</h3>",
          "<pre>{}</pre>", "<div>{}</div>", "<div><p>{}</p><p>{}</p></div>", "<section><h2>{}</h2><p>{}</p></section>",
          "<figure><figcaption>{}</figcaption></figure>", "<dl><dt>{}</dt><dd>{}</dd></dl>", "<header><h1>{}</h1><p>{}</p></header>")
_CONTAINERS = ("div class", "div id", "section class", "ul class", "aside class", "form id")

N_FEATURES = 22
HINTS = [11, 12, 13, 14]


def varied(source: str, seed: int) -> str:
    """The page with more blocks between those of its main text and around it, for training only.

    Some are main text in other forms, lists or tables; some are strange and hold sentences of the main text too, so
    only their names tell them from it.
    """
    rng, match = random.Random(seed), _INSIDE.search(source)
    if not match:
        return source
    own, names = _PARAGRAPH.findall(match[2]) or ["Some words."], sorted(AGAINST)

    def block() -> str:
        opened = rng.choice(_CONTAINERS)
        name, text = rng.choice(names), rng.choice(own)
        inner = "".join(f"<{t}>{text[:rng.randrange(20, 600)]}</{t}>" for t in rng.choices(("p", "h2", "li"), k=rng.randrange(1, 4)))
        return f'<{opened}="{name}">{inner}</{opened.split()[0]}>'

    def other_form() -> str:
        text = rng.choice(own)[:rng.randrange(5, 600)]
        return rng.choice(_FORMS).format(text, rng.choice(own)[:rng.randrange(5, 200)])

    parts = re.split(r"(?<=</p>)", match[2])
    for make in rng.choices((block, other_form), k=rng.randrange(2, 7)):
        parts.insert(rng.randrange(len(parts) + 1), make())
    tag = rng.choice((match[1], "article", "main"))
    whole = f"<{tag}>{''.join(parts)}</{tag}>"
    if rng.random() < 0.5:
        whole = f'<div class="{rng.choice(("wrapper", "page", "c1"))}">{whole}</div>'
    return source[:match.start()] + block() + whole + block() + source[match.end():]


def name_words(attributes: str) -> set[str]:
    """Words of names that may speak for or against the main text.

    A name speaks against it only as a whole: all its words do, or say where it is or what shape it has. So site-footer
    and share-buttons do; related-work and copyright-law name a subject and do not. A label is one name.
    """
    words = set()
    for attribute, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        for name in [value] if attribute.lower() == "aria-label" else value.split():
            own = set(_WORD.findall(_CAMEL.sub(" ", name).lower()))
            words |= own if own <= AGAINST | LAYOUT | FOR else own - AGAINST
    return words


class Page:
    """parent, tag, yes, no (hints) of each block element; pieces are (element, text, is in a link) in page order, None
    as text where a block begins or ends."""

    def __init__(self, source: str):
        self.parent, self.tag, self.yes, self.no, self.tags, self.controls = [-1], ["#page"], [0], [0], [0], [0]
        self.inside = [False]
        self.pieces: list[tuple[int, str | None, bool]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]  # open elements; inline ones stand for their block
        links, at = 0, 0
        failed: dict[str, int] = {}  # up to where there is no end tag of a name

        def hidden(name: str, at: int) -> int:
            """Where the content of an element ends: behind its end tag in the enclosing block, else at the next tag of a
            block."""
            blocks = {n for n, _ in stack if n in BLOCK}
            inner: dict[str, int] = {}
            place, near = at, None
            while found := _TOKEN.search(source, place):
                tag, ends = (found[2] or found[5] or "").lower(), found[1] or found[4]
                place = found.end()
                if ends and tag == name and at >= failed.get(name, 0):
                    return place
                if tag in BLOCK:
                    near = found.start() if near is None else near
                    if at < failed.get(name, 0) or (ends and not inner.get(tag) and tag in blocks):
                        break
                    inner[tag] = inner.get(tag, 0) + (-1 if ends and inner.get(tag) else 0 if ends else 1)
                elif tag in HARD and not ends:
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, place)
                    place = end.end() if end else len(source)
            failed[name] = max(failed.get(name, 0), place if found else len(source))
            return len(source) if near is None else near

        def close(to: int) -> None:
            nonlocal links
            while len(stack) > to:
                name, _ = stack.pop()
                links -= name == "a"
                if name in BLOCK:
                    self.pieces.append((stack[-1][1], None, False))

        while True:
            found = _TOKEN.search(source, at)
            text = source[at:found.start() if found else len(source)]
            if text:
                self.pieces.append((stack[-1][1], text, links > 0))
            if not found:
                break
            at = found.end()
            name = (found[2] or found[5] or "").lower()
            if not name:
                continue
            if found[1] or found[4]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        close(i)
                        break
                continue
            owner = stack[-1][1]
            if name in CONTROLS:
                self.controls[owner] += 1
            if name == "svg" and _SELF_CLOSED.search(found[3] if found[2] else found[6]):
                continue
            if name in RAW and name not in HARD and name not in CONTROLS:
                at = hidden(name, at)
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else at if name in CONTROLS else len(source)
                continue
            if name == "br":
                self.pieces.append((owner, " ", False))
            if name in VOID:
                if name == "hr":
                    self.pieces.append((owner, None, False))
                continue
            if name in BLOCK:
                closes = CLOSES.get(name, ())
                for i in range(len(stack) - 1, 0, -1):
                    open_name = stack[i][0]
                    if open_name == "p" or open_name in closes:
                        close(i)
                    elif open_name in HOLDS:
                        break
                self._add(name, found[3] if found[2] else found[6], stack[-1][1])
                self.pieces.append((stack[-1][1], None, False))
                stack.append((name, len(self.parent) - 1))
            else:
                self.tags[owner] += 1
                links += name == "a"
                stack.append((name, owner))

    def _add(self, name: str, attributes: str, parent: int) -> None:
        words = {name} | (name_words(attributes) if attributes and "=" in attributes else set())
        self.parent.append(parent)
        self.tag.append(name)
        if name == "header" and self.inside[parent]:
            words.discard("header")  # the article's own
        self.inside.append(self.inside[parent] or name in ("article", "main"))
        no = len(words & AGAINST)
        self.yes.append(len(words & FOR) if not no and name != "body" else 0)
        self.no.append(no)
        self.tags.append(0)
        self.controls.append(0)

    def labels(self) -> list[int] | None:
        """Per element whether marked-up structure says main text: inside article or main and nothing that speaks
        against it. None if the page has no such structure."""
        if not {"article", "main"} & set(self.tag):
            return None
        found = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            found[i] = int(self.inside[i] and self.no[i] == 0
                           and (found[self.parent[i]] or self.tag[i] in ("article", "main")))
        return found

    def features(self) -> list[list[float]]:
        n = len(self.parent)
        chars, linked, stops, tags, controls = [0] * n, [0] * n, [0] * n, [t + 1 for t in self.tags], list(self.controls)
        for owner, text, link in self.pieces:
            if text:
                size = len(text.strip())
                chars[owner] += size
                stops[owner] += len(_STOP.findall(text))
                if link:
                    linked[owner] += size
        own_chars = list(chars)
        children, paragraphs, kids, same = [0] * n, [0] * n, [[] for _ in range(n)], {}
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            for values in (chars, linked, stops, tags, controls):
                values[p] += values[i]
        for i in range(1, n):
            p = self.parent[i]
            kids[p].append(i)
            children[p] += 1
            paragraphs[p] += self.tag[i] == "p"
            same[p, self.tag[i]] = same.get((p, self.tag[i]), 0) + 1
        depth, yes, no, rows = [0] * n, [0] * n, [0] * n, []
        place = [0] * n
        for p in range(n):
            for k, i in enumerate(kids[p]):
                place[i] = k
        log, total = math.log1p, max(chars[0], 1)
        for i in range(n):
            p = self.parent[i] if i else 0
            if i:
                depth[i], yes[i], no[i] = depth[p] + 1, yes[p] + self.yes[p], no[p] + self.no[p]
            size, tag = max(chars[i], 1), self.tag[i]
            family, around = max(children[p], 1), max(chars[p], 1)
            rows.append([log(chars[i]), linked[i] / size, log(chars[i] / tags[i]), 100 * stops[i] / size, depth[i],
                         place[i] / family, log(family), same.get((p, tag), 1) / family, chars[i] / around,
                         log(chars[p] / family), paragraphs[i] / max(children[i], 1), self.yes[i], self.no[i], yes[i], no[i],
                         log(controls[i]), tag == "p", tag[0] == "h" and tag[1:].isdigit(), tag == "li",
                         linked[p] / around, log(own_chars[i]), chars[i] / total])
        return rows

    def decoded(self, chance: list[float], cut: float = 2.0) -> list[bool]:
        """Most probable consistent choice: main text begins at some elements, and may end at some below them, for good.

        States: 0 before the main text, 1 in it, 2 cut out of it. A parent's state allows itself and the next one.
        ``cut``: what a cut must win, in log odds.
        """
        n = len(self.parent)
        best = [[math.log(1 - c), math.log(c), math.log(1 - c)] for c in chance]
        choice = [[0, 1, 2] for _ in range(n)]  # of the element, by the state of its parent
        for i in range(n - 1, 0, -1):
            own, p = best[i], self.parent[i]
            choice[i] = [int(own[1] > own[0]), 2 if own[2] - cut > own[1] else 1, 2]
            for state in (0, 1, 2):
                pick = choice[i][state]
                best[p][state] += own[pick] - (cut if state == 1 and pick == 2 else 0)
        state = [int(best[0][1] > best[0][0])] + [0] * (n - 1)
        for i in range(1, n):
            state[i] = choice[i][state[self.parent[i]]]
        return [s == 1 for s in state]

    def text(self, keep: list[bool]) -> str:
        """Kept blocks, one a line: references decoded, white space as one blank."""
        blocks, parts = [], []
        for owner, text, _ in [*self.pieces, (0, None, False)]:
            if text is None:
                block = " ".join(html.unescape("".join(parts)).split())
                if block:
                    blocks.append(block)
                parts = []
            elif keep[owner]:
                parts.append(text)
        return "\n".join(blocks)
