"""Longest common subsequences of token lists, by bit-parallel rows (Hyyro 2004).

Small per-row helpers for the Arrow-batched functions in ``operators.rouge_lcs``.
"""

from __future__ import annotations

from collections import Counter
from math import isqrt


def _masks(tokens: list[str]) -> dict[str, int]:
    """For each token, an integer with a bit set at every place it stands."""
    masks: dict[str, int] = {}
    for place, token in enumerate(tokens):
        masks[token] = masks.get(token, 0) | (1 << place)
    return masks


def _next_row(row: int, mask: int, full: int) -> int:
    """Row of the table after one more token; a zero bit is a step up by one."""
    hits = row & mask
    return ((row + hits) | (row - hits)) & full


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence."""
    if len(a) < len(b):
        a, b = b, a
    masks, full = _masks(b), (1 << len(b)) - 1
    row = full
    for token in a:
        mask = masks.get(token)
        if mask:
            row = _next_row(row, mask, full)
    return len(b) - row.bit_count()


_KEEP_ALL_BITS = 1 << 27


def lcs_places(reference: list[str], masks: dict[str, int], candidate: list[str]) -> list[int]:
    """Places in ``reference`` of one longest common subsequence, last first.

    ``masks`` are the candidate's.  Walking back from the end, equal tokens are taken;
    otherwise the walk moves in the candidate only if that keeps strictly more, else
    in the reference.  Reference tokens the candidate lacks never change a row, so they
    are left out.  Of very long texts only every k-th row is kept and rows between are
    rebuilt, so memory grows with n^1.5 bits instead of n^2.
    """
    shared = [place for place, token in enumerate(reference) if token in masks]
    if len(shared) <= 1:
        return shared
    steps = [masks[reference[place]] for place in shared]
    full = (1 << len(candidate)) - 1
    stride = 1 if len(steps) * len(candidate) <= _KEEP_ALL_BITS else isqrt(len(steps))
    kept, row = [full], full
    for i, mask in enumerate(steps, start=1):
        row = _next_row(row, mask, full)
        if i % stride == 0:
            kept.append(row)
    wanted = len(candidate) - row.bit_count()

    block_start, block = -1, []

    def rebuilt(i: int) -> int:
        nonlocal block_start, block
        start = i // stride
        if start != block_start:
            block_start, block = start, [kept[start]]
            for mask in steps[start * stride : (start + 1) * stride - 1]:
                block.append(_next_row(block[-1], mask, full))
        return block[i - start * stride]

    row_at = kept.__getitem__ if stride == 1 else rebuilt

    places: list[int] = []
    i, j = len(steps), len(candidate)
    while wanted:
        # the walk stands where prefixes of i and j tokens have ``wanted`` in common
        below = (1 << j) - 1
        if not steps[i - 1] >> (j - 1) & 1:
            if j - (row_at(i - 1) & below).bit_count() == wanted:
                i -= 1
                continue
            # without token i there is less: the walk moves in the candidate as far as the next equal token
            j = (steps[i - 1] & below).bit_length()
        places.append(shared[i - 1])
        i, j, wanted = i - 1, j - 1, wanted - 1
    return places


def union_hits(references: list[list[str]], candidates: list[list[str]]) -> int:
    """Reference tokens covered by some candidate sentence, each token used once.

    For each reference sentence the covered places are united over all candidate
    sentences; a covered token counts as often as the candidates have it.
    """
    found: Counter[str] = Counter()
    all_masks = [_masks(s) for s in candidates]
    for sentence in references:
        own, covered = _masks(sentence), 0
        for candidate, masks in zip(candidates, all_masks, strict=True):
            # places of the words that both have
            shared = 0
            for token in own.keys() & masks.keys():
                shared |= own[token]
            if not shared & ~covered:
                continue  # nothing that this candidate could cover is left
            if shared & (shared - 1):
                # if all these places stand in the candidate in this order, each is covered
                others = iter(candidate)
                if not all(token in others for token in sentence if token in masks):
                    shared = 0
            if shared:
                covered |= shared
                continue
            for place in lcs_places(sentence, masks, candidate):
                covered |= 1 << place
        found.update(token for place, token in enumerate(sentence) if covered >> place & 1)
    # covered places are never more than the reference has, so the candidates' counts are the limit
    return sum((found & Counter(t for s in candidates for t in s)).values())
