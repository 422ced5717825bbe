"""A cache of bounded size for values that are costly to make."""

from __future__ import annotations

from collections.abc import Callable


class TwoGenerations:
    """Keeps at least the ``size`` last used keys and at most twice as many."""

    def __init__(self, size: int, make: Callable[[list], list]):
        self.size, self.make, self.young, self.old = size, make, {}, {}

    def ready(self, keys: list) -> dict:
        """A mapping that has every one of ``keys``; valid until the next call."""
        young = self.young
        keys = set(keys)
        missing = [k for k in keys if k not in young]
        if missing:
            if len(young) + len(missing) > self.size:
                self.old, self.young = young, {k: young[k] for k in keys if k in young}
                young = self.young
            old, new = self.old, []
            for k in missing:
                if k in old:
                    young[k] = old[k]
                else:
                    new.append(k)
            if new:
                young.update(zip(new, self.make(new), strict=True))
        return young

    def values(self, keys: list) -> list:
        """The values of ``keys``, in their order, with one lookup for each key that is known."""
        young = self.young
        out = list(map(young.get, keys))
        gaps = [i for i, v in enumerate(out) if v is None]
        if gaps:
            missing = {keys[i] for i in gaps}
            if len(young) + len(missing) > self.size:
                self.old, self.young = young, {}
                young = self.young
            new = []
            for k in missing:
                if (v := self.old.get(k)) is None:
                    new.append(k)
                else:
                    young[k] = v
            if new:
                young.update(zip(new, self.make(new), strict=True))
            for i in gaps:
                out[i] = young[keys[i]]
        return out
