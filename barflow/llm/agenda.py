"""Lightest derivations of weighted deductions, item by item from an agenda (Knuth's generalisation of
shortest paths to hypergraphs).

A deduction has one or more items it rests on, and a weight function that never gives less than any
of their weights and never falls when one of them rises (a superior function). Then the least weight on the
agenda is final, and every item is popped with its lightest derivation.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from heapq import heappop, heappush

Item = Hashable
#: Cost, then the letters of the edits: compared in this order.
Weight = tuple[int, str]
#: The consequences of an item that is now final, given all final ones (itself included).
Rules = Callable[[Item, dict[Item, Weight]], Iterable[tuple[Item, Weight]]]


def joined(*parts: Weight) -> Weight:
    """The superior function of all deductions here: costs add up and edits follow one another."""
    return sum(cost for cost, _ in parts), "".join(edits for _, edits in parts)


def lightest(axioms: Iterable[tuple[Item, Weight]], rules: Rules, goals: Iterable[Item]) -> dict[Item, Weight]:
    """The final weights up to the last of ``goals`` that can be derived."""
    agenda: list[tuple[Weight, Item]] = []
    offered: dict[Item, Weight] = {}
    final: dict[Item, Weight] = {}
    open_ = set(goals)

    def offer(item: Item, weight: Weight) -> None:
        if item not in final and (item not in offered or weight < offered[item]):
            offered[item] = weight
            heappush(agenda, (weight, item))

    for item, weight in axioms:
        offer(item, weight)
    while agenda and open_:
        weight, item = heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        open_.discard(item)
        for head, found in rules(item, final):
            offer(head, found)
    return final
