"""A literal, one-id-at-a-time model of the dwell rules, for randomized checks.

Plain Python loops over each id's sorted list -- deliberately the naive
sequential form, independent of the sliced Spark implementation.
"""

from __future__ import annotations

from collections import defaultdict

GAP = 7200


def by_id(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(tuple(r[1:]))
    return groups


def segments_from_points(events):
    """events: [(t, site)] of one id -> [(stime, site, etime)]."""
    out = []
    for t, site in sorted(events):
        if out and out[-1][1].lower() == site.lower() and t - out[-1][2] < GAP:
            out[-1][2] = t
        else:
            out.append([t, site, t])
    return [tuple(s) for s in out]


def segments_from_intervals(rows):
    """rows: [(stime, site, etime)] of one id -> [(stime, site, etime)]."""
    out = []
    for s, site, e in sorted(rows):
        if out and out[-1][1].lower() == site.lower() and s - out[-1][2] < GAP:
            out[-1][2] = e
        else:
            out.append([s, site, e])
    return [tuple(x) for x in out]


def is_short(seg, prev_end, dur, gap):
    return seg[2] - seg[0] < dur and seg[0] - prev_end < gap


def blocks_head_included(segs, dur, gap):
    blocks = []
    prev_end = None
    for s in segs:
        if blocks and is_short(s, prev_end, dur, gap):
            blocks[-1].append(s)
        else:
            blocks.append([s])
        prev_end = s[2]
    return blocks


def blocks_head_excluded(segs, dur, gap):
    """Every non-short segment alone; each maximal block of short ones together."""
    blocks = []
    prev_end = None
    open_short = False
    for s in segs:
        short = prev_end is not None and is_short(s, prev_end, dur, gap)
        if short and open_short:
            blocks[-1].append(s)
        else:
            blocks.append([s])
        open_short = short
        prev_end = s[2]
    return blocks


def trunc_div(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b >= 0) else -q


def equal_split(block):
    if len(block) == 1:
        return [block[0]]
    sites = []
    for _, site, _ in block:
        if site not in sites:
            sites.append(site)
    lo, hi = block[0][0], block[-1][2]
    step = trunc_div(hi - lo, len(sites))
    return [(lo + i * step, site, lo + (i + 1) * step) for i, site in enumerate(sites)]


def relay(block, min_run=3):
    if len(block) < min_run:
        return list(block)
    info = {}
    for pos, (s, site, e) in enumerate(block):
        if site not in info:
            info[site] = [s, 0, pos]
        info[site][0] = min(info[site][0], s)
        info[site][1] += e - s
    order = sorted(info.items(), key=lambda kv: (kv[1][0], kv[1][2]))
    out = []
    end = order[0][1][0]
    for site, (m, d, _) in order:
        start = max(end, m)
        end = start + d
        out.append((start, site, end))
    return out


def remerge(rows):
    out = []
    for s, site, e in rows:
        if out and out[-1][1].lower() == site.lower() and e - out[-1][2] < GAP:
            out[-1][2] = e
        else:
            out.append([s, site, e])
    return [tuple(x) for x in out]


def pipeline(points_or_intervals, kind):
    """Whole pipeline for every id: returns a sorted list of (id, stime, site, etime)."""
    out = []
    for ident, rows in by_id(points_or_intervals).items():
        if kind == "interval":
            segs = segments_from_intervals(rows)
        else:
            segs = segments_from_points(rows)
        if kind == "split_excl":
            res = set(x for b in blocks_head_excluded(segs, 300, 1800) for x in equal_split(b))
        elif kind == "split_incl":
            res = set(x for b in blocks_head_included(segs, 300, 300) for x in equal_split(b))
        elif kind == "interval":
            res = set(x for b in blocks_head_excluded(segs, 300, 300) for x in equal_split(b))
        elif kind == "relay":
            res = remerge([x for b in blocks_head_included(segs, 60, 180) for x in relay(b)])
        elif kind == "segments":
            res = segs
        else:
            raise ValueError(kind)
        out.extend((ident, *x) for x in res)
    return sorted(out)
