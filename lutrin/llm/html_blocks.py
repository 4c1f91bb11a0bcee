"""Blocks of text in a page's markup, with the part of the page they stand in."""

import html
import re

#: Parts of a page: its article, what its markup says is not content, and what it leaves open.
ARTICLE, FRAME, OPEN = 0, 1, 2

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
MARK = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot"
    " th thead title tr ul".split()
)
BREAKS = frozenset("br wbr img input".split())
RAW = frozenset("script style noscript template iframe textarea noembed noframes xmp".split())
FRAMES = frozenset("nav header footer aside form head title menu dialog button select svg math canvas object audio video map".split())
MAINS = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Names in class, id or role that mark a part as not content.
FRAME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies discussion disqus footer header menu modal nav navbar navigation newsletter notice notices"
    " pagination popup promo promoted related replies responses search share sharing sidebar social sponsor sponsored"
    " subscribe toolbar widget".split()
)


def marked(attributes):
    """Whether class, id or role name a part that is not content, and whether they name the article."""
    frame = body = False
    for match in MARK.finditer(attributes):
        names = (match[1] or match[2] or match[3] or "").lower()
        words = WORD.findall(names)
        frame |= any(w in FRAME_NAMES for w in words)
        body |= "articlebody" in names.replace("-", "").replace("_", "")
    return frame, body


def blocks(page):
    """(part, text) of every block with text, in page order; white space inside a block is one space."""
    out, held = [], []
    stack = []  # open (name, part); the last part holds for the text
    part = OPEN
    seen_article = False
    at = 0

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((part, text))

    while True:
        match = TAG.search(page, at)
        held.append(page[at : match.start() if match else len(page)])
        if not match:
            break
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if match[1]:
            if name in BLOCKS or any(n == name for n, _ in stack):
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if stack[i][0] in MAINS and name not in ("body", "html") and name not in MAINS:
                    break  # a stray end tag does not close the article
            part = stack[-1][1] if stack else OPEN
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            held.append(" ")
            continue
        if name in BREAKS:
            held.append(" ")
            continue
        block = name in BLOCKS
        if block:
            flush()
            if stack and stack[-1][0] == "p":
                stack.pop()
        frame, body = marked(match[3]) if match[3] and "=" in match[3] else (False, False)
        part = stack[-1][1] if stack else OPEN
        if name in MAINS and not any(n in MAINS for n, _ in stack):
            # an article is content even where an earlier part was left open
            stack = [] if part == FRAME else stack
            part, seen_article = ARTICLE, True
        elif name in ("html", "body"):
            pass
        elif part != FRAME and body:
            flush()
            part, seen_article = ARTICLE, True
        elif part != FRAME and (frame or name in FRAMES):
            flush()
            part = FRAME
        elif name not in BLOCKS or name in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "hr"):
            continue  # nothing that needs an end
        if name not in VOID and not match[3].rstrip().endswith("/"):
            stack.append((name, part))
    flush()
    if seen_article:  # then the article is the content, and all else is not
        out = [(ARTICLE if p == ARTICLE else FRAME, text) for p, text in out]
    return out
