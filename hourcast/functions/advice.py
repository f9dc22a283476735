"""Clothing advice (F18, F21-F24): bands, tips, sensitivity shifts and the band dimension.

Fixed values: the band labels and limits, the per-band style items and activity tips, the layering
tips, the sensitivity shifts and the clothing sentences. They are product text that results must
reproduce exactly, so they are written out verbatim below.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: temperature bands (upper limit inclusive; last band has none) ---------------
BANDS = [
    ("5도 이하", 5.0),
    ("10도 이하", 10.0),
    ("20도 이하", 20.0),
    ("28도 이하", 28.0),
    ("28도 초과", None),
]

# ---- fixed values: style items and activity tip per band ---------------------------------------
STYLE_RECOMMENDATIONS = {
    "5도 이하": {
        "items": {
            "캐주얼": {"아우터": ["🧥 롱패딩", "🧥 숏패딩"], "상의": ["🧶 두꺼운 니트", "👕 기모 맨투맨"], "하의": ["👖 기모 바지", "👖 코듀로이 팬츠"]},
            "비즈니스": {"아우터": ["🧥 두꺼운 오버핏 코트"], "상의": ["🧶 터틀넥 니트", "👔 셔츠"], "하의": ["👖 울 슬랙스"]},
            "스포티": {"아우터": ["🧥 벤치파카", "🧥 윈드브레이커"], "상의": ["👕 기능성 긴팔", "👕 후드티"], "하의": ["👖 트레이닝 팬츠"]},
            "페미닌": {"아우터": ["🧥 알파카 코트"], "상의": ["🧶 앙고라 니트"], "하의": ["👗 롱 기장 스커트", "🧦 두꺼운 스타킹"]},
            "미니멀": {"아우터": ["🧥 블랙 패딩"], "상의": ["👕 기본 터틀넥"], "하의": ["👖 와이드 슬랙스"]},
        },
        "activity_tip": "실내 활동을 추천해요. 외출 시에는 목도리, 장갑 등 방한용품을 꼭 챙기세요!",
    },
    "10도 이하": {
        "items": {
            "캐주얼": {"아우터": ["🧥 경량패딩", "🧥 야상"], "상의": ["👕 맨투맨", "👕 후드티"], "하의": ["👖 청바지", "👖 면바지"]},
            "비즈니스": {"아우터": ["🧥 트렌치 코트", "🧥 울 자켓"], "상의": ["👔 셔츠", "🧶 얇은 니트"], "하의": ["👖 슬랙스"]},
            "스포티": {"아우터": ["🧥 플리스 자켓"], "상의": ["👕 긴팔 티셔츠"], "하의": ["👖 조거 팬츠"]},
            "페미닌": {"아우터": ["🧥 트위드 자켓"], "상의": ["👚 블라우스", "🧶 가디건"], "하의": ["👗 미디 스커트"]},
            "미니멀": {"아우터": ["🧥 바람막이"], "상의": ["👕 기본 긴팔티"], "하의": ["👖 블랙진"]},
        },
        "activity_tip": "따뜻한 차 한 잔과 함께 공원을 산책하거나, 예쁜 카페에 가기 좋은 날씨예요.",
    },
    "20도 이하": {
        "items": {
            "캐주얼": {"아우터": ["🧥 가디건", "🧥 청자켓"], "상의": ["👕 셔츠", "👕 긴팔티"], "하의": ["👖 면바지", "👖 청바지"]},
            "비즈니스": {"아우터": ["🧥 얇은 자켓", "🧥 블레이저"], "상의": ["👔 셔츠"], "하의": ["👖 슬랙스", "👗 원피스"]},
            "스포티": {"아우터": ["🧥 바람막이"], "상의": ["👕 PK 티셔츠"], "하의": ["👖 반바지", "👖 레깅스"]},
            "페미닌": {"아우터": ["🧥 가디건"], "상의": ["👚 블라우스", "👗 얇은 원피스"], "하의": ["👗 롱스커트"]},
            "미니멀": {"아우터": ["🧥 얇은 바람막이"], "상의": ["👕 U넥 티셔츠"], "하의": ["👖 청바지"]},
        },
        "activity_tip": "야외 활동하기 완벽한 날씨! 자전거를 타거나 가까운 곳으로 피크닉을 떠나보세요.",
    },
    "28도 이하": {
        "items": {
            "캐주얼": {"상의": ["👕 반팔 티셔츠"], "하의": ["👖 반바지", "👖 린넨 바지"]},
            "비즈니스": {"상의": ["👔 린넨 셔츠", "👕 PK 셔츠"], "하의": ["👖 린넨 슬랙스"]},
            "스포티": {"상의": ["👕 기능성 반팔"], "하의": ["🩳 스포츠 반바지"]},
            "페미닌": {"상의": ["👚 퍼프 소매 블라우스"], "하의": ["👗 롱 원피스", "👗 숏츠"]},
            "미니멀": {"상의": ["👕 기본 반팔티"], "하의": ["👖 와이드 숏츠"]},
        },
        "activity_tip": "외출하기 좋은 날씨! 친구들과 만나거나 가벼운 산책을 즐겨보세요.",
    },
    "28도 초과": {
        "items": {
            "캐주얼": {"상의": ["🎽 민소매", "👕 얇은 반팔"], "하의": ["🩳 짧은 반바지"]},
            "비즈니스": {"상의": ["👔 반팔 셔츠"], "하의": ["👖 쿨맥스 슬랙스"]},
            "스포티": {"상의": ["🎽 기능성 민소매"], "하의": ["🩳 러닝 숏츠"]},
            "페미닌": {"상의": ["👗 끈 원피스"], "하의": ["🩳 린넨 숏츠"]},
            "미니멀": {"상의": ["🎽 슬리브리스 탑"], "하의": ["👖 3부 팬츠"]},
        },
        "activity_tip": "너무 더워요! 수분 섭취는 필수! 시원한 실내에서 영화나 전시를 보는 건 어때요?",
    },
}

# ---- fixed values: layering tips by daily range (>= 10, >= 7, else empty) ----------------------
LAYERING_TIPS = [
    (10.0, "🌡️ 일교차가 매우 큽니다! 겉옷을 여러 벌 준비하여 레이어링하세요."),
    (7.0, "🌡️ 일교차가 큰 편이니 얇은 겉옷을 준비하세요."),
]

# ---- fixed values: sensitivity shift added to the forecast (dashboard rule) --------------------
SENSITIVITY_SHIFT = {
    "매우 추위 탐": 3.0,
    "추위 탐": 1.5,
    "보통": 0.0,
    "더위 탐": -1.5,
    "매우 더위 탐": -3.0,
}

# ---- fixed values: clothing sentence rule (cold -2, hot +2; bands 25/20/15/10) -----------------
CLOTH_SENSE_SHIFT = {"cold": -2.0, "hot": 2.0}
CLOTH_SENSE_RULES = [
    (25.0, "반팔과 시원한 옷차림 추천! ☀️"),
    (20.0, "얇은 긴팔/반팔+가벼운 겉옷 추천 😄"),
    (15.0, "긴팔+가디건/자켓 추천 🧥"),
    (10.0, "스웨터/경량 패딩 추천 🌬️"),
    (None, "두꺼운 외투와 따뜻한 옷차림 필수! 🥶"),
]
CLOTH_SENSE_PREFIX = "예상 기온({t}°C: "

# ---- fixed values: Korean one-letter weekday -> English name -----------------------------------
WEEKDAY_KO_TO_EN = {"월": "Monday", "화": "Tuesday", "수": "Wednesday", "목": "Thursday",
                    "금": "Friday", "토": "Saturday", "일": "Sunday"}
# ------------------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def temp_band(avg_temp) -> Column:
    """band label; null / NaN fall through to the last band (comparisons are false)."""
    t = _c(avg_temp)
    expr = None
    for label, limit in BANDS:
        if limit is None:
            return expr.otherwise(F.lit(label))
        cond = F.coalesce(t <= F.lit(limit), F.lit(False)) & ~F.isnan(t)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def activity_tip(band) -> Column:
    """F22 (tip part): band -> activity tip via a literal map."""
    pairs = []
    for label, _ in BANDS:
        pairs += [F.lit(label), F.lit(STYLE_RECOMMENDATIONS[label]["activity_tip"])]
    return F.element_at(F.create_map(*pairs), _c(band))


def layering_tip(temp_range) -> Column:
    """>= 10 strong tip, >= 7 mild tip, else empty text."""
    r = _c(temp_range)
    (hi, hi_tip), (lo, lo_tip) = LAYERING_TIPS
    return (F.when(F.coalesce(r >= F.lit(hi), F.lit(False)), F.lit(hi_tip))
            .when(F.coalesce(r >= F.lit(lo), F.lit(False)), F.lit(lo_tip))
            .otherwise(F.lit("")))


def sensitivity_shift(level) -> Column:
    """shift for one of five sensitivity levels (unknown level -> null)."""
    pairs = []
    for k, v in SENSITIVITY_SHIFT.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), _c(level))


@F.pandas_udf(T.StringType())
def _format_1f_udf(x: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else f"{v:.1f}" for v in x], dtype="object")


def format_1f(x) -> Column:
    """``{x:.1f}``: rounds the exact binary value (half-even on exact ties), as Python and C printf do.

    Java's formatter rounds the shortest decimal form half-up instead (0.35 -> 0.4 where the double
    is 0.34999...), so this text helper runs as an Arrow-batched pandas UDF; it is only applied to
    summary / forecast-sized tables.
    """
    return _format_1f_udf(_c(x).cast("double"))


def clothing_sentence(temp, sensitivity, shown: Column | None = None) -> Column:
    """clothing sentence; the band uses the adjusted temperature, the text shows the raw one
    (``shown``: its text, where it has been made before rows are fanned out)."""
    t = _c(temp)
    s = _c(sensitivity)
    shift_pairs = []
    for k, v in CLOTH_SENSE_SHIFT.items():
        shift_pairs += [F.lit(k), F.lit(v)]
    adj = t + F.coalesce(F.element_at(F.create_map(*shift_pairs), s), F.lit(0.0))
    body = None
    for limit, text in CLOTH_SENSE_RULES:
        if limit is None:
            body = body.otherwise(F.lit(text))
            break
        cond = F.coalesce(adj >= F.lit(limit), F.lit(False))
        body = F.when(cond, F.lit(text)) if body is None else body.when(cond, F.lit(text))
    prefix_head, prefix_tail = CLOTH_SENSE_PREFIX.split("{t}")
    return F.concat(F.lit(prefix_head), format_1f(t) if shown is None else shown, F.lit(prefix_tail), body)


def band_dimension(spark: SparkSession) -> DataFrame:
    """band -> style -> category -> items, one row per (band, style, category).

    Fixed size (5 bands x 5 styles x 2-3 categories), so it is safe to broadcast.
    """
    rows = []
    for b_order, (band, limit) in enumerate(BANDS):
        spec = STYLE_RECOMMENDATIONS[band]
        for style, cats in spec["items"].items():
            for category, items in cats.items():
                rows.append((b_order, band, limit, style, category, list(items), spec["activity_tip"]))
    schema = T.StructType([
        T.StructField("band_order", T.IntegerType(), False),
        T.StructField("band", T.StringType(), False),
        T.StructField("band_upper", T.DoubleType(), True),
        T.StructField("style", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("items", T.ArrayType(T.StringType()), False),
        T.StructField("activity_tip", T.StringType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def band_case_sql(expr: str) -> str:
    """The same band rule as SQL text (used by oracles)."""
    parts = []
    for label, limit in BANDS:
        if limit is None:
            parts.append(f"ELSE '{label}'")
        else:
            parts.append(f"WHEN {expr} <= {limit} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def activity_case_sql(band_expr: str) -> str:
    whens = " ".join(f"WHEN {band_expr} = '{label}' THEN '{STYLE_RECOMMENDATIONS[label]['activity_tip']}'"
                     for label, _ in BANDS)
    return f"CASE {whens} END"


def layering_case_sql(expr: str) -> str:
    (hi, hi_tip), (lo, lo_tip) = LAYERING_TIPS
    return f"CASE WHEN {expr} >= {hi} THEN '{hi_tip}' WHEN {expr} >= {lo} THEN '{lo_tip}' ELSE '' END"
