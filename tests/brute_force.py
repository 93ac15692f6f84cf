"""The result tables in plain Python over lists of rows: slow, obvious, independent of the library."""

import itertools
import math
from collections import defaultdict
from fractions import Fraction


def levels(row, segments, label="TODOS"):
    for keep in itertools.product([True, False], repeat=len(segments)):
        yield tuple((row[s] if k else label, k) for s, k in zip(segments, keep))


def groups(rows, score, segments, cohort_of):
    found = defaultdict(list)
    for row in rows:
        if row[f"{score}_status"] != "score válido" or row[score] is None:
            continue
        for level in levels(row, segments):
            found[cohort_of(row), level].append((row[score], row["flag_1"]))
    return found


def in_tail(value, cutoff, high):
    return value >= cutoff if high else value <= cutoff


def cutoff(pairs, p):
    values = sorted(v for v, _ in pairs)
    rank = max(math.ceil(Fraction(str(p)) * len(values) / 100), 1)
    return values[rank - 1]


def percentiles(spec):
    ppv = {100 - p if spec.high_tail else p for p in spec.ppv_percentiles}
    return sorted(ppv | set(spec.dist_percentiles)), ppv


def ks(pairs, pos=None, neg=None):
    pos = sum(f == 1 for _, f in pairs) if pos is None else pos
    neg = sum(f == 0 for _, f in pairs) if neg is None else neg
    if not pos or not neg:
        return None
    return max(
        abs(sum(f == 1 and v >= s for v, f in pairs) / pos - sum(f == 0 and v >= s for v, f in pairs) / neg)
        for s in {v for v, _ in pairs}
    )


def names(level):
    return tuple(name for name, _ in level)


def report(rows, config):
    """All tables as {name: {key: values}}."""
    base_rows = [r for r in rows if r["safra"] in config.baseline_cohorts]
    prod_rows = [r for r in rows if r["safra"] in config.production_cohorts]
    out = defaultdict(dict)
    for spec in config.scores:
        plan, ppv = percentiles(spec)
        high = spec.high_tail
        base = {lv: g for (_, lv), g in groups(base_rows, spec.name, config.segments, lambda r: "b").items()}
        prod = groups(prod_rows, spec.name, config.segments, lambda r: str(r["safra"]))
        for lv, pairs in base.items():
            for p in plan:
                c = cutoff(pairs, p)
                n = sum(in_tail(v, c, high) for v, _ in pairs)
                out["baseline"][(spec.name, "baseline", *names(lv), p)] = (c, n, n / len(pairs) * 100)
        for (cohort, lv), pairs in prod.items():
            key, hits = (spec.name, cohort, *names(lv)), sum(f == 1 for _, f in pairs)
            out["ks"][key] = (ks(pairs),)
            whole = [x for (c, l), g in prod.items() if c == cohort and not any(k for _, k in l) for x in g]
            out["ks_cohort"][key] = (
                ks(pairs, sum(f == 1 for _, f in whole), sum(f == 0 for _, f in whole)),
            )
            psi = 0.0
            for p in plan:
                c = cutoff(pairs, p)
                tail = [f for v, f in pairs if in_tail(v, c, high)]
                if lv not in base:
                    out["percentiles"][(*key, p)] = (c, len(tail), len(tail) / len(pairs) * 100, None, 0, 0.0)
                    continue
                b = cutoff(base[lv], p)
                under = [f for v, f in pairs if in_tail(v, b, high)]
                share = len(under) / len(pairs) * 100
                out["percentiles"][(*key, p)] = (c, len(tail), len(tail) / len(pairs) * 100, b, len(under), share)
                x = share + 1e-10
                y = sum(in_tail(v, b, high) for v, _ in base[lv]) / len(base[lv]) * 100 + 1e-10
                psi += (x - y) * math.log(x / y)
                if p in ppv:
                    base_hits = sum(f == 1 for f in under) if under else None
                    own_hits = sum(f == 1 for f in tail)
                    out["capture"][(*key, p)] = (
                        base_hits,
                        own_hits,
                        hits,
                        base_hits / hits * 100 if hits and base_hits is not None else None,
                        own_hits / hits * 100 if hits else None,
                    )
                    out["precision"][(*key, p)] = (
                        base_hits / len(under) * 100 if under else None,
                        own_hits / len(tail) * 100,
                    )
            if lv in base:
                out["psi"][key] = (psi,)
    return out


def table(df, keys, values):
    """A DataFrame as {key: values}; fails on a repeated key."""
    rows = [(tuple(r[k] for k in keys), tuple(r[v] for v in values)) for r in df.collect()]
    found = dict(rows)
    assert len(found) == len(rows), "duplicate keys"
    return found


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        for a, b in zip(found[key], values, strict=True):
            same = a is None and b is None if a is None or b is None else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
            assert same, (key, found[key], values)
