"""Chunked automata (K1, K3) equal a one-message-at-a-time fold on dense
random message mixes: several incidents and clears per batch, batches
without bundles, bundles without incidents."""

import datetime as dt
import random

from roadlens.operators import lifecycle as L

T0 = dt.datetime(2024, 1, 28, 0, 0, 0)  # crosses a month boundary
INC = "route_num int, loc int, ts timestamp_ntz, occur_clear int, duration int, seq bigint, batch timestamp_ntz"
POS = "route_num int, loc int, user_id string, ts timestamp_ntz, seq bigint, batch timestamp_ntz"


def _random_log(seed, routes=3, hours=150):
    rnd = random.Random(seed)
    inc, pos, seq = [], [], 0
    for r in range(routes):
        for h in range(hours):
            b = T0 + dt.timedelta(hours=h)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
                seq += 1
                ts = b + dt.timedelta(seconds=rnd.randrange(3600))
                if rnd.random() < 0.5:
                    inc.append((r, rnd.randrange(23), ts, 1, 0, seq, b))
                else:
                    inc.append((r, rnd.randrange(23), ts, 0, 5 + rnd.randrange(10), seq, b))
            if rnd.random() < 0.6:
                for _ in range(rnd.randrange(1, 6)):
                    seq += 1
                    ts = b + dt.timedelta(seconds=rnd.randrange(3600))
                    pos.append((r, rnd.randrange(23), f"u{seq}", ts, seq, b))
    return inc, pos


def _fold(inc, pos):
    """The surveyed automaton, one message at a time, in (batch, rank, ts, seq) order."""
    msgs = [(b, 0, ts, seq, r, ("C" if o == 0 else "I"), loc, d) for r, loc, ts, o, d, seq, b in inc]
    bundles = {}
    for r, loc, _u, ts, seq, b in pos:
        bundles.setdefault((r, b), []).append(loc)
    msgs += [(b, 1, None, 0, r, "U", locs, None) for (r, b), locs in bundles.items()]
    msgs.sort(key=lambda m: (m[4], m[0], m[1], m[2] or dt.datetime.min, m[3]))
    state, hist = {}, []
    for b, _rk, ts, _seq, r, kind, payload, dur in msgs:
        st = state.setdefault(r, {"e": 0, "loc": None, "tot": 0, "aff": 0, "rep": 0, "clr": 0})
        if kind == "I" and st["e"] == 0:
            st.update(e=1, loc=payload, rep=st["rep"] + 1)
        elif kind == "U" and st["e"] == 1:
            st.update(e=2, tot=st["tot"] + len(payload), aff=st["aff"] + sum(1 for x in payload if x > st["loc"]))
        elif kind == "C" and st["e"] == 2:
            hist.append((ts, r, st["loc"], st["tot"], st["aff"], dur))
            st.update(e=0, loc=None, clr=st["clr"] + 1)
    return sorted(hist), {r: (s["e"], s["tot"], s["aff"], s["rep"], s["clr"]) for r, s in state.items()}


def _cap_fold(inc, cap=5):
    out = {}
    for r, _loc, ts, o, _d, seq, _b in sorted(inc, key=lambda x: (x[0], x[2], x[5])):
        a, rep, drop, clr, ign = out.get(r, (0, 0, 0, 0, 0))
        if o == 1:
            a, rep, drop = (a, rep, drop + 1) if a >= cap else (a + 1, rep + 1, drop)
        else:
            a, clr, ign = (a, clr, ign + 1) if a == 0 else (a - 1, clr + 1, ign)
        out[r] = (a, rep, drop, clr, ign)
    return out


def test_lifecycle_random_logs(spark):
    for seed in (1, 2, 3):
        inc, pos = _random_log(seed)
        i, p = spark.createDataFrame(inc, INC), spark.createDataFrame(pos, POS)
        want_hist, want_state = _fold(inc, pos)
        got_hist = sorted(tuple(r) for r in L.hist_traffic(i, p).collect())
        assert got_hist == want_hist, seed
        got_state = {r.route_num: (r.expect, r.users_total, r.users_affected, r.incidents_reported,
                                   r.incidents_cleared) for r in L.lifecycle_state(i, p).collect()}
        assert got_state == {r: v for r, v in want_state.items() if r in got_state}, seed


def test_capped_random_logs(spark):
    for seed in (4, 5):
        inc, _ = _random_log(seed, hours=80)
        got = {r.route_num: (r.active, r.reported, r.dropped, r.cleared, r.ignored)
               for r in L.capped_incidents(spark.createDataFrame(inc, INC)).collect()}
        assert got == _cap_fold(inc), seed
