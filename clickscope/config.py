"""Job parameters.

The original jobs read a JSON blob from a properties file.  Here the same
parameters are one frozen dataclass that every plan takes explicitly, so a
plan is a pure function of (tables, spec) and can be built, explained and
tested without touching any file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from clickscope.constants import ID_LIST_SEPARATOR, PARAMS_KEY


def _ints(values: Iterable[object] | str | int | None) -> tuple[int, ...]:
    if values is None:
        return ()
    if isinstance(values, int):
        values = (values,)
    if isinstance(values, str):
        values = [v for v in values.split(ID_LIST_SEPARATOR) if v.strip() != ""]
    return tuple(int(str(v).strip()) for v in values)


def _strs(values: Iterable[object] | str | int | None) -> tuple[str, ...]:
    if values is None:
        return ()
    if isinstance(values, int):
        values = (values,)
    if isinstance(values, str):
        values = [v for v in values.split(ID_LIST_SEPARATOR) if v.strip() != ""]
    return tuple(str(v).strip() for v in values)


def _blank_to_none(value: object) -> str | None:
    if value is None:
        return None
    text = str(value).strip()
    return text or None


# The parameter names of the original configuration.
PARAMETER_NAMES = {
    "startDate",
    "endDate",
    "startAge",
    "endAge",
    "professionals",
    "city",
    "gender",
    "keywords",
    "categoryIds",
    "targetPageFlow",
}

_ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def _iso_date(value: object) -> str | None:
    """A date bound as ``yyyy-MM-dd``: the fact table's date column is that
    text, so bounds compare as strings and any other spelling would filter
    silently wrong."""
    text = _blank_to_none(value)
    if text is not None and not _ISO_DATE.fullmatch(text):
        raise ValueError(f"date bound {text!r} is not yyyy-MM-dd")
    return text


@dataclass(frozen=True)
class FilterSpec:
    """Which actions a job looks at, and which page flow it follows.

    Every bound is optional; ``None`` means "no filter" (a blank value in
    the original configuration meant the same).  Date bounds compare as
    ``yyyy-MM-dd`` strings and are inclusive; age bounds are inclusive.

    ``professionals``, ``genders``, ``city_ids``, ``keywords`` and
    ``category_ids`` were declared in the original configuration but never
    applied.  They are honoured here as ``isin`` filters, empty meaning
    none: professionals and genders on the user's ``professional`` /
    ``gender``, city ids on the action's ``city_id``, keywords on its
    ``search_keyword``, and category ids on the categories that the category
    jobs count (clicked, ordered or paid; the page and area jobs have none).
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    target_page_flow: tuple[int, ...] = ()
    professionals: tuple[str, ...] = ()
    genders: tuple[str, ...] = ()
    city_ids: tuple[int, ...] = ()
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = field(default=())

    def __post_init__(self) -> None:
        object.__setattr__(self, "start_date", _iso_date(self.start_date))
        object.__setattr__(self, "end_date", _iso_date(self.end_date))
        for name in ("start_age", "end_age"):
            value = _blank_to_none(getattr(self, name))
            object.__setattr__(self, name, None if value is None else int(value))
        object.__setattr__(self, "target_page_flow", _ints(self.target_page_flow))
        object.__setattr__(self, "professionals", _strs(self.professionals))
        object.__setattr__(self, "genders", _strs(self.genders))
        object.__setattr__(self, "city_ids", _ints(self.city_ids))
        object.__setattr__(self, "keywords", _strs(self.keywords))
        object.__setattr__(self, "category_ids", _ints(self.category_ids))

    @property
    def jump_pairs(self) -> tuple[tuple[int, int], ...]:
        """Consecutive steps of the target flow: ``1,2,3`` -> ``(1,2), (2,3)``."""
        flow = self.target_page_flow
        return tuple(zip(flow[:-1], flow[1:]))

    def with_flow(self, flow: Iterable[int] | str) -> FilterSpec:
        return replace(self, target_page_flow=_ints(flow))

    @classmethod
    def from_mapping(cls, params: Mapping[str, object]) -> FilterSpec:
        """Build from the original parameter names (``startDate`` ...)."""
        return cls(
            start_date=params.get("startDate"),
            end_date=params.get("endDate"),
            start_age=params.get("startAge"),
            end_age=params.get("endAge"),
            target_page_flow=params.get("targetPageFlow") or (),
            professionals=params.get("professionals") or (),
            genders=params.get("gender") or (),
            city_ids=params.get("city") or (),
            keywords=params.get("keywords") or (),
            category_ids=params.get("categoryIds") or (),
        )

    @classmethod
    def from_properties(cls, text: str, key: str = PARAMS_KEY) -> FilterSpec:
        """Build from a properties file's parameter line, e.g.

        ``condition.params.json={startDate:"2018-11-01", endAge: "50", ...}``

        The value is a JSON object whose keys may lack quotes, possibly
        continued over lines ending in ``\\``.  Values are strings, whole
        numbers, null or lists of strings and whole numbers.  Anything else,
        and any unknown name, raises ``ValueError``: a parameter that is
        silently dropped would run the job over data nobody asked for.
        """
        joined = re.sub(r"\\\s*\n", " ", text)
        for line in joined.splitlines():
            name, sep, value = line.partition("=")
            if sep and name.strip() == key:
                return cls.from_mapping(_parameters(value))
        raise ValueError(f"no {key} line in the properties text")


_STRING_OR_KEY = re.compile(r'"(?:[^"\\]|\\.)*"|[A-Za-z_]\w*(?=\s*:)')


def _parameters(value: str) -> dict[str, object]:
    """Names and values of a parameter object; raises on whatever is not one."""
    quoted = _STRING_OR_KEY.sub(lambda m: m[0] if m[0].startswith('"') else f'"{m[0]}"', value)

    def once(pairs: list[tuple[str, object]]) -> dict[str, object]:
        names = [name for name, _ in pairs]
        if len(set(names)) < len(names):
            raise ValueError("a parameter is given twice")
        return dict(pairs)

    params = json.loads(quoted, object_pairs_hook=once)  # its error is a ValueError
    if not isinstance(params, dict):
        raise ValueError("the parameters are not an object")
    unknown = set(params) - PARAMETER_NAMES
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    for name, given in params.items():
        for item in given if isinstance(given, list) else [given]:
            if isinstance(item, bool) or not isinstance(item, (str, int, type(None))):
                raise ValueError(f"parameter {name} has a value of the wrong kind")
    return params


# The parameters of the original job configuration.
REFERENCE_SPEC = FilterSpec(
    start_date="2018-11-01",
    end_date="2018-12-28",
    start_age=20,
    end_age=50,
    target_page_flow=(1, 2, 3, 4, 5, 6, 7),
)

# The parameters used with tables derived from the driver's
# test data (its events span 2024-01-01 .. 2024-01-30).
DRIVER_SPEC = FilterSpec(
    start_date="2024-01-03",
    end_date="2024-01-28",
    start_age=20,
    end_age=50,
    target_page_flow=(1, 2, 3, 4, 5, 6, 7),
)
