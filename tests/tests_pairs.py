"""Pairs of sightings by the rule, one event after the other."""


def pairs_brute(rows, dmax, gap):
    import math

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        return 6371000.0 * 2 * math.atan2(math.sqrt(x), math.sqrt(1 - x))

    # every sighting against the latest position of each other bus
    last, want = {}, []
    for i, (route, bus, t, la, lo) in sorted(enumerate(rows), key=lambda x: (x[1][2], x[0])):
        for (r, other), j in last.items():
            if r == route and other != bus and t - rows[j][2] <= gap and hav(la, lo, rows[j][3], rows[j][4]) <= dmax:
                want.append((i, j) if bus < other else (j, i))
        last[route, bus] = i
    return sorted(want)
