"""Risk bands, drift levels and their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
RISK_LOW_BELOW = 0.3
RISK_MEDIUM_BELOW = 0.7

PSI_MODERATE = 0.1
PSI_SIGNIFICANT = 0.25
PSI_MAX_CATEGORIES = 10
PSI_BINS = 10
PSI_FLOOR = 1e-4

PSI_LEVEL_TEXT = {
    "en": {"significant": "significant", "moderate": "moderate", "stable": "stable"},
    "ru": {"significant": "значимый сдвиг", "moderate": "умеренный сдвиг", "stable": "стабильно"},
}

DRIFT_MESSAGE = {
    "en": ("Drift found in {n} features. Attention required.", "No drift found. The data is stable."),
    "ru": ("Обнаружен дрейф в {n} признаках! Требуется внимание.", "Дрейф не обнаружен. Данные стабильны."),
}

FACTOR_DIRECTION = {"en": ("raises risk", "retains"), "ru": ("к оттоку", "удерживает")}

RECOMMENDATION = {
    "en": {
        "Low": "Loyal customer: offer the loyalty programme.",
        "Medium": "May leave: personal offer with 10-15% discount and a manager call.",
        "High": "Likely to leave: urgent 20-30% discount and a personal manager.",
    },
    "ru": {
        "Low": "✅ Клиент лоялен. Предложите программу лояльности для укрепления отношений и увеличения частоты покупок.",
        "Medium": "⚠️ Рекомендуется персональное предложение со скидкой 10-15% и звонок от менеджера для выяснения потребностей.",
        "High": "🚨 Немедленно предложите специальную акцию со скидкой 20-30%, персонального менеджера и эксклюзивные предложения.",
    },
}

RISK_DESCRIPTION = {
    "en": {
        "Low": "Very likely to stay",
        "Medium": "May leave but can be retained",
        "High": "High risk of loss",
    },
    "ru": {
        "Low": "Клиент с высокой вероятностью останется с вами",
        "Medium": "Клиент может уйти, но есть шанс его удержать",
        "High": "Высокий риск потери клиента! Требуется срочное вмешательство",
    },
}

FEATURE_TEXT = {
    "en": {
        "Age": "age",
        "FrequentFlyer": "frequent flyer",
        "AnnualIncomeClass": "income class",
        "ServicesOpted": "number of services",
        "AccountSyncedToSocialMedia": "synced to social media",
        "BookedHotelOrNot": "booked a hotel",
        "services_per_age": "services relative to age",
        "flyer_and_hotel": "frequent flyer and hotel",
        "income_x_services": "income and number of services",
    },
    "ru": {
        "Age": "Возраст",
        "FrequentFlyer": "Частый перелётчик",
        "AnnualIncomeClass": "Уровень дохода",
        "ServicesOpted": "Число услуг",
        "AccountSyncedToSocialMedia": "Соцсети синхронизированы",
        "BookedHotelOrNot": "Бронировал отель",
        "services_per_age": "Услуги относительно возраста",
        "flyer_and_hotel": "Частый перелётчик и отель",
        "income_x_services": "Доход и число услуг",
    }
}
# ----------------------------------------------------------------------------


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability < RISK_LOW_BELOW, "Low")
        .when(probability < RISK_MEDIUM_BELOW, "Medium")
        .when(probability.isNotNull(), "High")
    )


def apply_threshold(probability: Column, threshold: Column | float) -> Column:
    return (probability >= threshold).cast("int")


def psi_level(psi: Column, language: str = "en") -> Column:
    text = PSI_LEVEL_TEXT[language]
    return (
        F.when(psi > PSI_SIGNIFICANT, text["significant"])
        .when(psi >= PSI_MODERATE, text["moderate"])
        .when(psi.isNotNull(), text["stable"])
    )


def drift_message(n_drifted: Column, language: str = "en") -> Column:
    found, none = DRIFT_MESSAGE[language]
    head, tail = found.split("{n}")
    return F.when(n_drifted > 0, F.concat(F.lit(head), n_drifted.cast("string"), F.lit(tail))).otherwise(none)


def recommendation_table(spark: SparkSession, language: str = "en") -> DataFrame:
    """Three fixed rows: risk level -> description and advice."""
    rows = [(k, RISK_DESCRIPTION[language][k], RECOMMENDATION[language][k]) for k in ("Low", "Medium", "High")]
    return spark.createDataFrame(rows, "risk_level string, description string, recommendation string")


def readable_factor(feature: Column, pairs: dict[str, tuple[str, ...]], language: str = "en") -> Column:
    """Human name of a feature; interaction names are resolved to their parts.

    ``pairs`` maps generated names (``poly_k``) to the multiplied features.
    """
    names = FEATURE_TEXT.get(language, {})
    resolved = {**names, **{k: " × ".join(names.get(p, p) for p in parts) for k, parts in pairs.items()}}
    if not resolved:
        return feature
    table = F.create_map(*[F.lit(x) for kv in resolved.items() for x in kv])
    return F.coalesce(F.try_element_at(table, feature), feature)
