"""What a worker remembers between texts, within a bound."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

#: Longer keys are not remembered.
LONGEST = 64


class Remembered(dict):
    """key -> what `find` makes of a list of distinct keys. Holds up to 2 * most: the younger half and the older one."""

    def __init__(self, find: Callable[[list], list], most: int):
        super().__init__()
        self.find, self.most, self.older = find, most, {}

    def all(self, keys: list) -> list[Any]:
        """The value of each key."""
        out = list(map(self.get, keys))
        if None not in out:
            return out
        places: dict[Any, list[int]] = {}
        for i, value in enumerate(out):
            if value is None:
                places.setdefault(keys[i], []).append(i)
        new = []
        for key, at in places.items():
            value = self.older.get(key)
            if value is None:
                new.append(key)
            else:
                self[key] = value
                for i in at:
                    out[i] = value
        for key, value in zip(new, self.find(new) if new else ()):
            if len(key) <= LONGEST:
                self[key] = value
            for i in places[key]:
                out[i] = value
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        return out
