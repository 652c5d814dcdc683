"""Job parameters as data: partner roll-up rule sets, partner-list specs, cutoffs.

Nothing here computes; the operators read these objects.  A deployment on real data
builds its own ``Program`` (real channel labels, real tier words) and passes it in;
``FIXTURE_PROGRAM`` uses the neutral labels of the driver test tables (FIXTURES.md).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rollup:
    """One partner roll-up rule set: a searched CASE over a channel column.

    ``groups`` is tested in order; a value in ``members`` becomes ``label``.
    ``fold_case`` upper-cases the input before the test, ``else_upper`` upper-cases
    the value returned when no group matches (otherwise it is returned as is).
    """

    groups: tuple[tuple[tuple[str, ...], str], ...]
    fold_case: bool = False
    else_upper: bool = False


@dataclass(frozen=True)
class ListSpec:
    """One partner's historical member list and how it folds into the unified base."""

    key: str
    partner: str
    phone: str
    tier: str | None = None
    join_dt: str | None = None
    channel: str | None = None
    city: str | None = None
    # flag: "tier" -> '1' if tier in high_tiers else '0'; "none" -> NULL;
    #       "side_match" -> '1' if the phone is on the side list else '0'
    flag: str = "tier"
    high_tiers: tuple[str, ...] = ()
    # top-1 per phone: rank tiers by position in tier_rank (first is kept first),
    # then latest join date; rank_by_join_dt alone keeps the latest join date
    tier_rank: tuple[str, ...] | None = None
    rank_by_join_dt: bool = False
    distinct: bool = True
    # side list joined on comma-stripped phone
    side: str | None = None
    side_tier: str | None = None          # tier taken from the side list
    default_tier: str | None = None       # tier text when the side list has no row
    side_distributor: str | None = None   # distributor taken from the side list
    side_filter: tuple[str, ...] = ()     # side rows kept: side_distributor IN (...)


@dataclass(frozen=True)
class Program:
    """Everything the three jobs need besides the input tables."""

    rollup_cutoff_reg: Rollup
    rollup_cutoff_order: Rollup
    rollup_relabel: Rollup
    rollup_daily_order: Rollup
    rollup_daily_reg: Rollup
    lists: tuple[ListSpec, ...]
    channel_pattern: str            # substring that marks the own-store channel
    staff_channel: str              # staff.channel value of that channel
    member_yes: str                 # is_member value for a member purchase
    bind_id_type: str = "unionId"
    bind_app_id: int = 4
    cutoff_date: dt.date = dt.date(2023, 12, 25)   # first day *after* the cutoff
    phone_source_type: int = 0
    # how many digits the published member id is padded / cut to
    member_id_width: int = 9
    # tier_pick: "lowest" keeps rank 1 first as the lists are written; "highest" flips it
    tier_pick: str = "lowest"
    # strict: cast member ids with ANSI cast (bad ids fail the job); else try_cast
    strict_id_cast: bool = True
    distributors: tuple[str, ...] | None = None     # optional filter on the cutoff order branch
    # joins on phone and member: keys with more than this share of the rows are salted (None: only NULL keys are spread)
    hot_key_share: float | None = None
    # published column names, by table ("group_two", "base", "performance") and column; others keep theirs
    names: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    @property
    def cutoff_last_day(self) -> dt.date:
        return self.cutoff_date - dt.timedelta(days=1)

    def list_spec(self, key: str) -> ListSpec:
        for spec in self.lists:
            if spec.key == key:
                return spec
        raise KeyError(key)


# ---------------------------------------------------------------------------
# Fixed values for the driver test tables (neutral labels, FIXTURES.md part B).
# Channel roles: A, B, C are multi-store partners rolled up to one partner;
# "CHN B OLD" is the old name of B that only the cutoff job folds into B.
# ---------------------------------------------------------------------------
A1, A2, A = "CHN A (A1)", "CHN A (A2)", "CHN A"
B1, B2, B, B_OLD = "CHN B (B1)", "CHN B (B2)", "CHN B", "CHN B OLD"
C1, C2 = "CHN C (C1)", "CHN C (C2)"
A_AND, B_AND, C_AND = "CHN A (A1) and CHN A (A2)", "CHN B (B1) and CHN B (B2)", "CHN C (C1) and CHN C (C2)"
C_AMP = "CHN C (C1) & CHN C (C2)"
D1, E1, F1, G1, H1, I1, J1, K1 = (
    "CHN D (D1)", "CHN E (E1)", "CHN F (F1)", "CHN G (G1)",
    "CHN H (H1)", "CHN I (I1)", "CHN J (J1)", "CHN K (K1)",
)

# Channel label of a code k is CHANNEL_LABELS[k % 19] (FIXTURES.md L(k)).
CHANNEL_LABELS = (
    "CHN A (A1)", "CHN A (A2)", "CHN B (B1)", "CHN B (B2)", "CHN C (C1)", "CHN C (C2)",
    "CHN D (D1)", "CHN E (E1)", "CHN F (F1)", "CHN G (G1)", "CHN H (H1)", "CHN I (I1)",
    "CHN J (J1)", "CHN B OLD", "CHN A", "chn d (d1)", "ONLINE", "CHN K (K1)", "CHN B",
)

FIXTURE_PROGRAM = Program(
    # cutoff job, registration channel: upper-cased test, old B name folds into B
    rollup_cutoff_reg=Rollup(
        groups=(((A, A1, A2), A_AND), ((B_OLD, B1, B2), B_AND), ((C1, C2), C_AND)),
        fold_case=True,
    ),
    # cutoff job, order distributor
    rollup_cutoff_order=Rollup(
        groups=(((A1, A2), A_AND), ((B_OLD, B1, B2), B_AND), ((C1, C2), C_AND)),
        fold_case=True,
    ),
    # rename of the cutoff-group labels to base partner labels
    rollup_relabel=Rollup(groups=(((A_AND,), A), ((B_AND,), B), ((C_AND,), C_AMP))),
    # daily job, order / staff distributor (case-sensitive, old B name not folded)
    rollup_daily_order=Rollup(groups=(((A1, A2), A), ((B1, B2), B), ((C1, C2), C_AMP))),
    # daily job, registration channel: upper-cased test and upper-cased fallback
    rollup_daily_reg=Rollup(
        groups=(((A1, A2, A), A), ((B1, B2, B), B), ((C1, C2), C_AMP)),
        fold_case=True,
        else_upper=True,
    ),
    lists=(
        ListSpec("list_d", D1, phone="phone", tier="tier",
                 high_tiers=("T1", "T2", "T3", "T4")),
        ListSpec("list_e", E1, phone="phone_number", tier="historical_vip_tier",
                 join_dt="historical_join_dt", city="city",
                 high_tiers=("T2", "T3", "T4", "T5"),
                 tier_rank=("T1", "T2", "T3", "T4", "T5")),
        ListSpec("list_f", F1, phone="phone", join_dt="historical_join_dt",
                 flag="none", rank_by_join_dt=True),
        ListSpec("list_g", G1, phone="phone", flag="tier",
                 high_tiers=("T2", "T3", "T4"), tier_rank=("T1", "T2", "T3", "T4"),
                 side="list_g_high", side_tier="historical_vip_tier", default_tier="T1"),
        ListSpec("list_h", H1, phone="phone", tier="historical_vip_tier",
                 channel="historical_join_channel", high_tiers=("T3", "T4", "T5")),
        ListSpec("list_i", I1, phone="mobile", tier="grade",
                 high_tiers=("T2", "T3", "T4", "T5")),
        ListSpec("list_c", C_AMP, phone="phone", tier="historical_vip_tier",
                 join_dt="historical_join_dt", channel="historical_join_channel",
                 city="historical_city", flag="side_match",
                 side="high_tier", side_distributor="distributor_name", side_filter=(C1, C2)),
        ListSpec("list_j", J1, phone="phone", join_dt="historical_join_dt",
                 channel="historical_join_channel", flag="none", distinct=False),
        ListSpec("list_a", A, phone="phone", tier="historical_vip_tier",
                 join_dt="historical_join_dt", channel="historical_join_channel",
                 high_tiers=("T3", "T2", "T4"), tier_rank=("T1", "T2", "T3", "T4")),
        ListSpec("list_b", B, phone="phone", tier="historical_vip_tier",
                 join_dt="historical_join_dt", channel="historical_join_channel",
                 high_tiers=("T4", "T5")),
        ListSpec("list_k", K1, phone="phone", flag="none"),
    ),
    channel_pattern="CHN",
    staff_channel="CHN",
    member_yes="Y",
)

# list_no of the fixture hist_list view -> list key (FIXTURES.md "Suggested list_no")
FIXTURE_LIST_NO = {
    0: "list_d", 1: "list_e", 2: "list_f", 3: "list_g", 4: "list_h", 5: "list_i",
    6: "list_c", 7: "list_j", 8: "list_a", 9: "list_b", 10: "list_k",
}

# combined (cutoff-job) partner label carried by each list in the S1 / wecom snapshot fixtures
FIXTURE_COMBINED_LABEL = {
    "list_d": D1, "list_e": E1, "list_f": F1, "list_g": G1, "list_h": H1, "list_i": I1,
    "list_c": C_AND, "list_j": J1, "list_a": A_AND, "list_b": B_AND, "list_k": K1,
}

DEFAULT_RUN_TS = dt.datetime(2024, 3, 5, 10, 7, 0)


@dataclass(frozen=True)
class RunContext:
    """Per-run values: the one clock reading used for current_date and the batch stamp."""

    run_ts: dt.datetime = field(default=DEFAULT_RUN_TS)

    @property
    def run_date(self) -> dt.date:
        return self.run_ts.date()
