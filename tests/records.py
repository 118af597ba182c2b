"""Raw records of both sources for tests, made by rule; `python -m tests.records` writes them to tests/fixtures.

Two accounts with two campaigns, a set each and three ads; three days. Awkward cases: a record without actions, campaigns that are renamed
on the last day, ads that are seen on the first day only, an ad id that both sources have, fractional conversions, numbers in quotes, an
action that nothing reads, and no video field on the first day.
"""

from __future__ import annotations

import json
from pathlib import Path

DAYS = ["2026-01-01", "2026-01-02", "2026-01-03"]
SHARED_AD = "550017"


def _places():
    """(day, account, campaign, ad) of every record, from 1; the third ads of the second account stop after the first day."""
    return [(d, a, c, k) for d in (1, 2, 3) for a in (1, 2) for c in (1, 2) for k in (1, 2, 3) if d == 1 or (a, k) != (2, 3)]


def _value(d, a, c, k, step, size):
    """A number that differs between places and looks irregular."""
    return (d * 911 + a * 353 + c * 197 + k * 89) * step % size


def _ad(source, a, c, k):
    return SHARED_AD if (a, c, k) == (1, 1, 1) else f"{source}{a}{c}{k}"


def meta() -> list[dict]:
    out = []
    for d, a, c, k in _places():
        v = lambda step, size, p=(d, a, c, k): _value(*p, step, size)
        name = f"Demo campaign {a}-{c}" + (" (renamed)" if c == 2 and d == 3 else "")
        row = {
            "date_start": DAYS[d - 1], "date_stop": DAYS[d - 1], "account_id": f"71{a}", "account_name": f"Demo account {a}", "campaign_id": f"72{a}{c}", "campaign_name": name, "adset_id": f"73{a}{c}", "adset_name": f"Demo set {a}-{c}",
            "ad_id": _ad("74", a, c, k), "ad_name": f"Demo ad {a}-{c}-{k}", "spend": f"{40 + v(37, 61000) / 100:.2f}", "impressions": str(900 + v(29, 17011)), "inline_link_clicks": str(11 + v(13, 307)), "reach": str(500 + v(31, 8009)),
        }
        if (d, a, c, k) != (1, 1, 1, 1):
            counts = {"lead": v(3, 14), "video_view": 90 + v(17, 2203), "onsite_conversion.ig_profile_view": v(7, 43), "purchase": v(11, 5), "post_engagement": v(23, 499)}
            row["actions"] = [{"action_type": t, "value": str(n)} for t, n in counts.items()]
            row["action_values"] = [{"action_type": "lead", "value": f"{v(41, 190000) / 100:.2f}"}]
        out.append(row)
    return out


def google() -> list[dict]:
    out = []
    for d, a, c, k in _places():
        v = lambda step, size, p=(d, a, c, k): _value(*p, step, size)
        row = {
            "date": DAYS[d - 1], "account_id": f"81{a}", "account_name": f"Demo client {a}", "campaign_id": f"82{a}{c}", "campaign_name": f"Demo search {a}-{c}", "ad_group_id": f"83{a}{c}", "ad_group_name": f"Demo group {a}-{c}", "ad_id": _ad("84", a, c, k), "ad_name": f"Demo text {a}-{c}-{k}",
            "impressions": 700 + v(19, 4001), "clicks": 9 + v(5, 283), "cost": round(20 + v(43, 390_000_007) / 1_000, 6) + 0.000731, "conversions": round(v(47, 900) / 100, 2), "conversions_value": round(v(53, 80021) / 100, 2),
        }
        row["cost"] = round(row["cost"], 6)
        if d > 1:
            row["video_trueview_views"] = v(3, 401)
        out.append(row)
    return out


if __name__ == "__main__":
    for name, rows in (("meta", meta()), ("google", google())):
        (Path(__file__).parent / "fixtures" / f"{name}.json").write_text("[\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n")
