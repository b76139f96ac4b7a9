"""Main-body extraction of page text by tree scoring (problem 1) and the residue test it shares with problem 5.

A page is read as a tree: page > regions > blocks > lines. A block is opened by a title, a heading or a link
line (label, teaser); links that stand by themselves (menus, notices, prompts) part the regions. Every prose
line earns points for its length and its commas; it passes them to its block, where they are discounted by the
square of the block's link density (the share of its lines that are links), and from there to its region. The
region with the most points is the body; siblings on either side join it while what they earn outweighs the
links that part them from it. A line of the body is kept if its block has points of its own.

What kind a line is (``pagemodel``) only makes it a leaf with points or a link; which lines stay is decided by
the scores of the containers.
"""

from __future__ import annotations

import re

from .lexicon import MACHINE
from .pagemodel import (
    BLANK, FURNITURE, HEADING, LABEL, MENU, PROSE, RESIDUE, SHORT, TEASER, TITLE,
    Page, addresses, code_lines, cue_share, is_filler, is_tutorial, may_have_field, open_fields, speaks_of_the_page,
)

#: Points of a headline or sub-heading that opens a body, and what each link line between two regions costs.
HEADLINE, LINK = 6.0, 1.0
#: Share of a block's points that must be left after the discount for its lines to stay.
LEFT = 0.3
#: A label that carries its headline on the same line opens no list.
_INLINE = re.compile(r"(?:[:：]|\s[—–>|•·»/-])\s*\S")


def settle_short(page: Page) -> None:
    """Decide the lines without a sentence end: sub-heading (HEADING) or teaser of another article.

    Below a label of its own such lines are teasers until furniture, a title or two paragraphs in a row end the
    list. Elsewhere one is a sub-heading if prose follows it before any label, teaser or furniture and it isn't
    part of a list of teasers.
    """
    kind = page.kind
    filled = [i for i, k in enumerate(kind) if k != BLANK]
    listed, run = False, 0
    for j, i in enumerate(filled):
        k = kind[i]
        run = run + 1 if k == PROSE else 0
        if k == LABEL:
            listed = not _INLINE.search(page.low[i])
        elif k in (FURNITURE, MENU, TITLE) or run >= 2:
            listed = False
        if k != SHORT:
            continue
        text = page.raw[i].strip()
        before = kind[filled[j - 1]] if j else None
        after = kind[filled[j + 1]] if j + 1 < len(filled) else None
        if listed or (text.isupper() and text.count(" ") >= 3):
            kind[i] = TEASER  # in capitals names can't be told from words; that long it is a headline
        elif before in (LABEL, TEASER) and after != PROSE:
            kind[i] = TEASER
        elif after in (PROSE, HEADING, RESIDUE) or (after == SHORT and before in (PROSE, TITLE, HEADING)):
            kind[i] = HEADING
        elif before in (PROSE, TITLE, HEADING) and after not in (SHORT, TEASER):
            kind[i] = HEADING
        else:
            kind[i] = TEASER


def points(page: Page, i: int) -> float:
    """Points of a line: 1, one for each comma up to 6, and one for each 100 characters up to 3, less the share of sentences that speak to the reader."""
    k, low = page.kind[i], page.low[i]
    if k == TITLE:
        return HEADLINE
    if k != PROSE:
        return 0.0
    spoken = cue_share(low, []) if addresses(low) else 0.0
    return (1 + min(low.count(",") + low.count("，"), 6) + min(len(low) / 100, 3)) * (1 - spoken if spoken < 0.5 else 0.0)


class Block:
    """Lines under one opener, the points of each, and how many are links."""

    __slots__ = ("lines", "own", "links")

    def __init__(self) -> None:
        self.lines: list[int] = []
        self.own: list[float] = []
        self.links = 0

    def add(self, i: int, own: float, link: bool = False) -> None:
        self.lines.append(i)
        self.own.append(own)
        self.links += link

    def left(self) -> float:
        """What the link density leaves of the points."""
        return (1 - self.links / len(self.lines)) ** 2

    def score(self) -> float:
        return sum(self.own) * self.left()


def tree(page: Page) -> tuple[list[list[Block]], list[float]]:
    """Regions of blocks in page order, and the cost of the links that stand before each region.

    A teaser takes the paragraph below it into its block where that is one paragraph alone, or where the teaser
    before it has one too: that is the teaser's own text. Regions of links (lists) and of text alternate.
    """
    kind = page.kind
    filled = [i for i, k in enumerate(kind) if k != BLANK]
    regions: list[list[Block]] = []
    before: list[float] = []
    cost, last, with_text, taken = 0.0, None, False, False

    def opened(block: Block, link: bool) -> None:
        nonlocal cost, last
        if last is not link or cost:
            regions.append([])
            before.append(cost)
            cost, last = 0.0, link
        regions[-1].append(block)

    for j, i in enumerate(filled):
        k = kind[i]
        if taken:
            taken = False
            continue
        if k in (FURNITURE, MENU):
            cost += LINK
            with_text = False
            continue
        block = Block()
        if k in (LABEL, TEASER):
            block.add(i, 0.0, True)
            if k == TEASER and j + 1 < len(filled) and kind[filled[j + 1]] == PROSE:
                alone = j + 2 >= len(filled) or kind[filled[j + 2]] != PROSE
                taken = with_text = alone or with_text
                if taken:
                    block.add(filled[j + 1], points(page, filled[j + 1]))
            opened(block, True)
            continue
        with_text = False
        if k in (TITLE, HEADING) or last is not False or cost:
            opened(block, False)
        else:
            block = regions[-1][-1]
        block.add(i, points(page, i))
    return regions, before


def region_score(blocks: list[Block]) -> float:
    """Points of the blocks, discounted once more by the link density of the whole region."""
    n = sum(len(b.lines) for b in blocks)
    return sum(b.score() for b in blocks) * (1 - sum(b.links for b in blocks) / n) ** 2


def body(scores: list[float], links: list[float], before: list[float]) -> tuple[int, int]:
    """First region of the body and the one after its last: the best region and the siblings that outweigh the links between.

    From the best region outwards a side is extended to where the sum of points less links is largest.
    """
    best = max(range(len(scores)), key=lambda r: (scores[r], -r), default=-1)
    if best < 0 or scores[best] <= 0:
        return 0, 0
    ends = []
    for step in (-1, 1):
        total = most = 0.0
        end, r = best, best + step
        while 0 <= r < len(scores):
            total += scores[r] - links[r] - before[r if step > 0 else r + 1]
            if total > most:
                most, end = total, r
            r += step
        ends.append(end)
    return ends[0], ends[1] + 1


def kept_lines(page: Page) -> list[bool]:
    """True for each line of the article: the lines of the body's blocks that kept their points, without lines of no points at its two ends."""
    regions, before = tree(page)
    scores = [region_score(r) for r in regions]
    links = [LINK * sum(b.links for b in r) for r in regions]
    first, end = body(scores, links, before)
    lines = [(i, own) for r in regions[first:end] for b in r if b.left() >= LEFT for i, own in zip(b.lines, b.own)]
    while lines and lines[0][1] <= 0 and page.kind[lines[0][0]] == PROSE:
        lines.pop(0)
    while lines and lines[-1][1] <= 0 and page.kind[lines[-1][0]] == PROSE:
        lines.pop()
    keep = [False] * len(page.kind)
    for i, _ in lines:
        keep[i] = page.kind[i] in (PROSE, HEADING, TITLE)
    return keep


def residue_verdict(page: Page) -> str | None:
    """Why a page has residue in place of content, or None.

    'field': an unfilled field stands in the article; 'fields', 'filler', 'message': nothing else than fields,
    filler text or messages of servers and scripts is left beside the furniture. Fields between quotation
    marks, in code and in lines beside which the text speaks of templates don't count, the latter as long as
    prose outweighs them.
    """
    fields = filler = message = genuine = shown = 0
    open_at: list[int] = []
    speaks: list[bool] = []
    with_fields = any(map(may_have_field, page.raw))
    code = code_lines(page.raw) if with_fields else set()
    above = False
    for i, k in enumerate(page.kind):
        if k in (BLANK, MENU, LABEL) or i in code:
            continue
        raw = page.raw[i]
        n_open = len(open_fields(raw)) if with_fields else 0
        if k == FURNITURE:
            fields += n_open
            continue
        if n_open:
            if is_tutorial(raw) or (above and len(raw.strip()) < 80):
                shown += 1
                continue
            fields += n_open
            open_at.append(i)
        elif is_filler(raw):
            filler += 1
        elif page.residue[i]:
            message += 1
        elif k == PROSE:
            genuine += 1
            if genuine <= 2:
                speaks.append(speaks_of_the_page(page.low[i]))
            above = with_fields and raw.rstrip().endswith(":") and is_tutorial(raw)
            continue
        above = False
    if shown > genuine:
        fields += shown
    if open_at and genuine:
        return "field"
    if genuine and not (genuine == 1 and any(x in low for low in page.low for x in MACHINE)):
        return "message" if genuine <= 2 and all(speaks) and not fields + filler else None
    if fields:
        return "fields"
    if filler:
        return "filler"
    if message:
        return "message"
    return None
