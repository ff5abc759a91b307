"""Job parameters (the reference's JSON condition object, made typed).

Every optional filter key is switched off by ``""`` *or* by being missing;
values are compared with typed predicates, never spliced into SQL text.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

DEFAULT_TASK_ID = "task-0"

# Fixed values of the reference workload (equal values give equal results).
FILTER_KEYS = ("startDate", "endDate", "startAge", "endAge", "professionals", "gender", "city")
VISIT_SECONDS_LIMIT = 10          # visit length buckets: <= 10 s and > 10 s
STEP_LIMIT = 5                    # step buckets: < 5 and >= 5 actions
DEFAULT_SAMPLE_SIZE = 1000        # sessions in the proportional sample
TOP_CATEGORIES = 10
SESSIONS_PER_CATEGORY = 10
HOT_PRODUCTS = 10
BUYERS_PER_PRODUCT = 2
PRODUCTS_PER_AREA = 3
SHOWN_CITIES = 2                  # cities named in the remark before the rest
OTHER_CITIES_LABEL = "其他"        # "other" entry of the remark
DEFAULT_BAN_THRESHOLD = 100       # clicks per user, ad and day
ADS_PER_AREA = 3
BATCH_SECONDS = 5                 # micro-batch interval
TREND_MINUTES = 60                # last hour
TREND_SLIDE = "10 seconds"        # slide of the original last-hour window


def _opt(v):
    if v is None:
        return None
    s = str(v)
    return None if s == "" else s


@dataclass(frozen=True)
class ActionFilter:
    """Optional conjuncts on actions joined with their user (F1-F8)."""

    start_date: str | None = None      # inclusive, yyyy-MM-dd string order
    end_date: str | None = None        # inclusive
    start_age: int | None = None
    end_age: int | None = None
    professional: str | None = None
    gender: str | None = None
    city_id: int | None = None

    @staticmethod
    def from_json(text: str) -> "ActionFilter":
        obj = json.loads(text) if text else {}
        age = lambda k: None if _opt(obj.get(k)) is None else int(obj[k])
        city = _opt(obj.get("city"))
        return ActionFilter(
            start_date=_opt(obj.get("startDate")),
            end_date=_opt(obj.get("endDate")),
            start_age=age("startAge"),
            end_age=age("endAge"),
            professional=_opt(obj.get("professionals")),
            gender=_opt(obj.get("gender")),
            city_id=None if city is None else int(city),
        )

    def to_json(self) -> str:
        """Condition text stored with results, keys as the reference names them."""
        vals = [self.start_date, self.end_date, self.start_age, self.end_age,
                self.professional, self.gender, self.city_id]
        return json.dumps({k: "" if v is None else str(v) for k, v in zip(FILTER_KEYS, vals)},
                          ensure_ascii=False, separators=(",", ":"))


@dataclass(frozen=True)
class PageFlow:
    """Target page flow, e.g. ``"1,2,3,4,5,6,7"`` (comma separated)."""

    pages: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)

    @staticmethod
    def parse(text: str) -> "PageFlow":
        return PageFlow(tuple(int(p) for p in text.split(",") if p.strip() != ""))

    @property
    def from_pages(self) -> tuple[int, ...]:
        return self.pages[:-1]

    @property
    def jumps(self) -> list[tuple[int, int]]:
        return list(zip(self.pages[:-1], self.pages[1:]))

    @property
    def jump_labels(self) -> list[str]:
        return [f"{a}_{b}" for a, b in self.jumps]


@dataclass(frozen=True)
class SampleParams:
    size: int = DEFAULT_SAMPLE_SIZE


@dataclass(frozen=True)
class AdsParams:
    ban_threshold: int = DEFAULT_BAN_THRESHOLD
    batch_seconds: int = BATCH_SECONDS  # micro-batch length; the batch twin groups rows by it
    trend_minutes: int = TREND_MINUTES
    sliding_window: str = f"{TREND_MINUTES} minutes"
    sliding_slide: str = TREND_SLIDE
    settle_seconds: int = 60        # a slot is judged when the newest click is this much past its end
    max_lead_seconds: int = 3600    # rows dated further ahead of their arrival are rejected


@dataclass(frozen=True)
class Params:
    """Everything one run needs, with the fixture test values as defaults below."""

    task_id: str = DEFAULT_TASK_ID
    conditions: str | None = None  # the condition object as given; stored with results
    actions: ActionFilter = field(default_factory=ActionFilter)
    flow: PageFlow = field(default_factory=PageFlow)
    sample: SampleParams = field(default_factory=SampleParams)
    ads: AdsParams = field(default_factory=AdsParams)
    trace_date: str | None = None
    top_categories: int = TOP_CATEGORIES
    sessions_per_category: int = SESSIONS_PER_CATEGORY
    hot_products: int = HOT_PRODUCTS
    buyers_per_product: int = BUYERS_PER_PRODUCT
    ads_per_area: int = ADS_PER_AREA
    products_per_area: int = PRODUCTS_PER_AREA
    other_label: str = OTHER_CITIES_LABEL

    def conditions_text(self) -> str:
        return self.conditions or self.actions.to_json()

    @staticmethod
    def from_json(text: str) -> "Params":
        """Filters and, where it is given, the page flow of a condition object."""
        flow = _opt((json.loads(text) if text else {}).get("targetPageFlow"))
        return Params(conditions=text or None, actions=ActionFilter.from_json(text),
                      flow=PageFlow.parse(flow) if flow else PageFlow())

    def as_dict(self) -> dict:
        return asdict(self)
