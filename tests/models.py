"""Plain-Python models of the keyed operators, to check them on random sequences."""

from __future__ import annotations


def scan_tags(events, rules):
    """Tags of one device by looking through the whole ring at each arrival.

    ``events``: ``(event_id, type, value)`` in arrival order.
    """
    ring, given, out = [], set(), []

    def give(event_id, tag, once=True):
        if once and (tag, event_id) in given:
            return False
        given.add((tag, event_id))
        out.append((event_id, tag))
        return True

    for event in events:
        ring = (ring + [event])[-rules.ring :]
        if not given:
            give(event[0], "FirstTagForThisKey")
        if 1 < len(ring) < rules.ring:
            give(event[0], f"{len(ring)}RecordsForThisKey", once=False)
        in_band, high = 0, False
        for event_id, kind, value in ring:
            if kind == "TEMP" and rules.band_low <= value < rules.band_high:
                in_band += 1
                if in_band > 1:
                    give(event_id, "SeveralTemperaturesIn70s")
            elif kind == "CO2" and value > rules.co2_above:
                high = True
            if high and in_band > 1:
                if give(event_id, "HighCO2WithSeveralTemperaturesIn70s"):
                    break
    return out


def remembered(ids, size):
    """Which ids pass a memory of the last ``size`` distinct ids; written as a list."""
    memory, out = [], []
    for one in ids:
        new = one not in memory
        if not new:
            memory.remove(one)
        memory.append(one)
        memory = memory[-size:]
        out.append(new)
    return out
