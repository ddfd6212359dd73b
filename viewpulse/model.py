"""Data model: dimensions, log layouts, metric constants and result-table contracts, all as plain data."""

from __future__ import annotations

from dataclasses import dataclass, field

DELIMITER = chr(127)

#: Roll-up dimensions in priority order, and the area pair used by the real-time metrics.
D5 = ("province_id", "city_id", "platform", "device_provider", "fw_version")
D2 = ("province_id", "city_id")
ALL = "ALL"

#: grouping columns that hold a time: their values grow in number with the log
TIME_LABELS = ("minute", "bucket", "index_time", "event_second", "day", "parse_time")

#: Province code that stands for "area unknown".
UNKNOWN_PROVINCE = "2"

# ---- fixed values -------------------------------------------------------------------------------------------------
FIRST_FRAME_CAP_US = 50_000_000
HAS_TYPES = ("1", "2", "3", "4", "5", "8", "9")
EVENT_IDS = ("1", "2", "3", "4", "6", "7", "8", "9", "10", "11", "12", "13", "14", "15", "16")
STALL_BANDS_US_PER_S = (0, 10_000, 50_000)
EPG_BANDS_US = (100_000, 300_000, 2_000_000)
STALL_CAUSES = {
    "operator": ("2", "5", "6", "8", "11"),
    "family": ("15",),
    "cdn": ("1", "9", "10", "12"),
    "terminal": ("3", "13", "14"),
}
EVENT_CATEGORIES = {
    "terminal": ("3", "13", "14", "15"),
    "operator": ("2", "4", "7", "10", "153", "154", "155"),
    "cdn": ("1", "6", "8", "9", "16", "151"),
    "family": ("11", "12"),
}
DENSE_CAUSES = tuple(str(i) for i in range(1, 18) if i != 16)
DETAIL_PAGE = "3"
SERIES_POINTS = 30
#: resolution in minutes -> retention
RESOLUTIONS = {1: "1 hour", 15: "1 day", 60: "7 days"}
PERIODS = ("15MIN", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "HALFYEAR", "YEAR")
_DAY_S = 86_400
#: seconds a previous-period total stays usable: twice the longest length of the period
PERIOD_TTL_S = {
    "RT": 2 * 300,
    "15MIN": 2 * 900,
    "HOUR": 2 * 3_600,
    "DAY": 2 * _DAY_S,
    "WEEK": 2 * 7 * _DAY_S,
    "MONTH": 2 * 31 * _DAY_S,
    "QUARTER": 2 * 93 * _DAY_S,
    "HALFYEAR": 2 * 183 * _DAY_S,
    "YEAR": 2 * 366 * _DAY_S,
}
# -------------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LogLayout:
    """Positional layout of one log type.

    ``fields`` maps column -> (position, kind) with kind ``text``, ``long`` (bad text rejects the line), ``count``
    (bad text counts as 0), ``time`` (``yyyyMMddHHmm[ss]``, bad text rejects) or ``any_time`` (may be missing).  ``required`` / ``required_offline`` are positions that
    must not be blank; the line must also reach the highest position read.
    """

    code: str
    min_fields: int
    fields: dict[str, tuple[int, str]]
    required: tuple[int, ...] = ()
    required_offline: tuple[int, ...] | None = None
    offline_kinds: dict[str, str] = field(default_factory=dict)

    def needed(self, mode: str) -> tuple[int, ...]:
        if mode == "offline" and self.required_offline is not None:
            return self.required_offline
        return self.required

    def kind(self, column: str, mode: str) -> str:
        if mode == "offline":
            return self.offline_kinds.get(column, self.fields[column][1])
        return self.fields[column][1]

    @property
    def length(self) -> int:
        return max(self.min_fields, 1 + max(position for position, _ in self.fields.values()))


def _area(probe: int, provider: int, platform: int, province: int, city: int, fw: int) -> dict[str, tuple[int, str]]:
    return {
        "probe_id": (probe, "text"), "province_id": (province, "text"), "city_id": (city, "text"),
        "platform": (platform, "text"), "device_provider": (provider, "text"), "fw_version": (fw, "text"),
    }


_PLAY_COUNTERS = ("play_seconds", "freeze_count", "freeze_time", "latency", "down_bytes", "down_seconds")

LOGS: dict[str, LogLayout] = {
    "terminal_info": LogLayout("1", 17, _area(1, 3, 4, 5, 6, 7) | {
        "device_id": (2, "text"), "device_model_id": (8, "text"), "device_version": (9, "text"), "mode": (10, "text"),
        "user_id": (11, "text"), "probe_ip": (12, "text"), "mac": (13, "text"), "mac2": (14, "text"),
        "ev_version": (15, "text"), "manager_name": (16, "text"),
    }),
    "state": LogLayout("2", 7, {
        "probe_id": (1, "text"), "has_id": (2, "text"), "state": (3, "text"), "event_time": (4, "time"),
    }),
    "play_request": LogLayout("3", 41, _area(4, 5, 6, 7, 8, 9) | {
        "session_part": (1, "text"), "has_type": (10, "text"),
        "play_seconds": (12, "count"), "freeze_count": (13, "count"), "freeze_time": (14, "count"),
        "latency": (16, "count"), "down_bytes": (17, "count"), "expert_id": (18, "text"),
        "event_time": (23, "time"), "down_seconds": (24, "count"), "http_rsp_time": (28, "text"),
        "m3u8_http_rsp_time": (29, "text"), "tcp_syn_time": (32, "text"), "tcp_low_win_pkts": (38, "text"),
        "tcp_retrans_rate": (40, "text"),
    }, required_offline=(12, 13, 14, 16, 17), offline_kinds=dict.fromkeys(_PLAY_COUNTERS, "long")),
    "lag": LogLayout("4", 16, _area(2, 3, 4, 5, 6, 7) | {
        "has_id": (1, "text"), "export_id": (8, "text"), "event_time": (10, "time"),
    }),
    "play_fail": LogLayout("5", 7, _area(1, 2, 3, 4, 5, 6) | {
        "event_time": (7, "time"), "has_type": (11, "text"), "status_code": (13, "text"),
    }),
    "epg": LogLayout("6", 13, _area(1, 5, 2, 3, 4, 6) | {
        "page_type": (8, "text"), "event_time": (9, "time"), "requests": (11, "long"),
        "http_rsp_time": (12, "long"), "page_suc_cnt": (14, "count"),
    }, required=(2, 3, 8, 11, 12), required_offline=(2, 3, 4, 5, 6, 8, 11, 12, 14),
        offline_kinds={"page_suc_cnt": "long", "event_time": "any_time"}),
    "image": LogLayout("7", 10, _area(1, 5, 2, 3, 4, 6) | {
        "event_time": (8, "time"), "requests": (10, "long"), "suc_cnt": (12, "long"), "le3s_cnt": (13, "long"),
    }, required=(8, 10, 12, 13), required_offline=(10, 12, 13), offline_kinds={"event_time": "any_time"}),
    "login": LogLayout("9", 14, _area(1, 5, 2, 3, 4, 6) | {
        "pages": (9, "long"), "suc_pages": (10, "long"),
    }, required=(2, 9, 10)),
    "http_error": LogLayout("10", 13, _area(2, 3, 4, 5, 6, 7) | {
        "http_rsp_code": (10, "text"), "cnt": (13, "long"),
    }, required=(3, 4, 5, 6, 7, 10, 13)),
    "event": LogLayout("11", 16, _area(2, 3, 4, 5, 6, 7) | {
        "event_time": (8, "time"), "event_id": (10, "text"), "cnt": (13, "long"),
    }, required=(1, 2, 5, 6, 8, 10, 13), required_offline=(1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)),
}

_D5_OUT = ("provinceID", "cityID", "platform", "deviceProvider", "fwVersion")
#: library column -> column of the result tables
_D5_RENAME = dict(zip(D5, _D5_OUT)) | {"period": "period", "parse_time": "parseTime"}


@dataclass(frozen=True)
class TableContract:
    """A result table: library column -> stored column, in stored order."""

    name: str
    columns: dict[str, str]


def _table(name: str, measures: dict[str, str]) -> TableContract:
    return TableContract(name, dict(zip(D5, _D5_OUT)) | measures | {"parse_time": "parseTime", "period": "period"})


TABLES: dict[str, TableContract] = {t.name: t for t in (
    _table("T_IMAGE_INDEX", {"fast_rate": "fastrate", "succ_rate": "succRate"}),
    _table("T_DOWN_BYTES_INDEX", {"down_bytes": "downBytes"}),
    _table("T_FIRST_FRAME_INDEX", {"latency": "latency"}),
    _table("T_PLAY_SUCC_RATE", {"play_succ_rate": "playSuccRate"}),
    _table("T_PLAY_LAG", {"buffer_rate": "playCountRate", "stalled_plays": "playCount"}),
    _table("T_USER_LAG", {"user_rate": "userRate", "fault_users": "faultUser"}),
    _table("T_BUSINESS_ONLINE_DATA", {"has_type": "hasType", "play_seconds": "playSum"}),
    _table("T_STARTUSER", {"online_users": "startUserCount"}),
    _table("T_STREAMUSER", {"play_users": "playUserCount"}),
    _table("T_FAULT", {"export_id": "exportId", "lag_count": "faultCount"}),
    _table("T_USER_LAG_DISTRIBUTION", {"normal_users": "greenUser", "occasional_users": "blueUser",
                                       "more_users": "yellowUser", "serious_users": "redUser"}),
    _table("T_BUSINESS_QUALITY", {"freeze_seconds": "freezeTime", "freeze_count": "freezeCount",
                                  "play_seconds": "playSeconds", "plays": "playCount"}),
    _table("T_PLAYUSER_CAUSE", {"operator_cnt": "causeType1", "family_cnt": "causeType2", "cdn_cnt": "causeType3",
                                "terminal_cnt": "causeType4", "cause_sum": "causeSum"}),
    _table("T_EPG_DISTRIBUTION", {"page_type": "pagetype", "band1": "range1", "band2": "range2", "band3": "range3",
                                  "band4": "range4"}),
    TableContract("T_SLICE_HEALTH", {"worst": "worst", "bad": "bad", "normal": "normal", "great": "great",
                                     "parse_time": "parseTime", "period": "period"}),
    _table("T_TERMINAL_COUNT", {"terminals": "userCount"}),
    _table("T_LOGIN_SUCC_INDEX", {"succ_rate": "succRate"}),
    _table("T_DETAIL_LOAD_SUCC", {"load_succ_rate": "loadSuccRate"}),
    _table("T_EVENT_TREND", {"event_id": "eventID", "count_sum": "countSum"}),
    _table("T_HTTP_ERROR_CODE", {"http_rsp_code": "errorCode", "total": "total"}),
)}

TERMINAL_INFO_COLUMNS = tuple(LOGS["terminal_info"].fields)

#: key prefixes of the real-time series
SERIES_PREFIX = {
    "plays": "ALL_PLAY", "users": "ALL_USER", "online": "ALL_START", "lag_plays": "LAG_PLAY_RATE",
    "lag_cause": "LAG_CAUSE", "fault_users": "FAULT_USER", "play_fail": "PLAY_FAIL",
    "service_time": "PROGRAME_TYPE", "stall": "LAG_PHASE", "epg_bands": "EPG_TIME_DELAY", "epg_mean": "EPG_RSP",
    "event": "EVENT_TREND", "http_error": "HTTP_ERRORCODE", "traffic": "DOWN_BYTES", "first_frame": "FIRST_FRAME",
    "image": "IMAGE_LOAD", "plays_offline": "ALL_PLAY_OFFLINE", "terminal_count": "INFO",
}
