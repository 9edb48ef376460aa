"""A worker's memory of words it has dealt with."""

from __future__ import annotations


class Memo:
    """A dictionary of bounded size: of its two generations the older is
    forgotten when the younger is full; what is found moves to the younger."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def recall(self, keys: set) -> tuple[dict, list]:
        """What is known of ``keys``, and the rest."""
        young, old = self.young, self.old
        known = {k: young[k] if k in young else old[k] for k in keys if k in young or k in old}
        return known, [k for k in keys if k not in known]

    def add(self, found: dict) -> None:
        if len(self.young) + len(found) > self.limit:
            self.old, self.young = self.young, {}
        self.young.update(found)
