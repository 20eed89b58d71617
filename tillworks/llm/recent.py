"""A bounded memory that lets go of what was not asked for lately."""

from __future__ import annotations


class Recent:
    """A dictionary of two generations: when the young one is full it becomes the old one, and the old one goes.

    What is asked for in the old generation moves to the young one, so frequent entries stay; no more than
    twice ``size`` entries are held.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value

    def forget_old(self) -> None:
        """Let the old generation go, as at the end of a task whose worker lives on."""
        self.old = {}
