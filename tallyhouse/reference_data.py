"""Dictionaries of the warehouse (fixed values) as small DataFrames.

They are literal rows, at most 19 each, so a broadcast of any of them is bounded
by this file and does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# (source_system_id, source_system_code, source_system_name, description)
SOURCE_SYSTEMS = [
    (1, "ABS", "Автоматизированная банковская система", None),
    (2, "CRM", "CRM", None),
    (3, "DBO", "Дистанционное банковское обслуживание", None),
]
ABS, CRM, DBO = 1, 2, 3

# (channel_id, channel_code, channel_name, is_digital)
CHANNELS = [
    (1, "BRANCH", "Отделение", False),
    (2, "ATM", "Банкомат", False),
    (3, "IB", "Интернет-банк", True),
    (4, "MB", "Мобильный банк", True),
    (5, "CC", "Контакт-центр", False),
    (6, "WEB_BANK", "Веб-банк (DBO / Open API)", True),
    (7, "MOBILE_APP", "Мобильное приложение", True),
    (8, "API", "Программный интерфейс", True),
    (9, "EMAIL", "Электронная почта", True),
    (10, "TELEPHONE", "Телефон", False),
    (11, "WEB", "Веб-форма", True),
    (12, "REFERRAL", "Рекомендация", False),
    (13, "POS", "Терминал (POS)", False),
]

# (product_type_id, product_type_code, product_type_name)
PRODUCT_TYPES = [
    (1, "CARD", "Карта"),
    (2, "ACCOUNT", "Счёт"),
    (3, "DEPOSIT", "Депозит"),
    (4, "LOAN", "Кредит"),
]
DEFAULT_PRODUCT_TYPE = 1

# (operation_type_id, operation_type_code, operation_type_name)
OPERATION_TYPES = [
    (1, "PAYMENT", "Платёж"),
    (2, "TRANSFER", "Перевод"),
    (3, "CASH_IN", "Пополнение"),
    (4, "CASH_OUT", "Снятие"),
    (5, "POS", "Оплата картой"),
    (6, "SALARY", "Зарплата / зачисление"),
    (7, "CARD_PAYMENT", "Платёж картой"),
    (8, "TRANSFER_IN", "Входящий перевод"),
    (9, "TRANSFER_OUT", "Исходящий перевод"),
    (10, "LOAN_PAYMENT", "Погашение кредита"),
    (11, "CASH_WITHDRAWAL", "Снятие наличных"),
    (12, "FEE", "Комиссия"),
    (13, "INTEREST", "Проценты"),
    (14, "DEPOSIT_TOPUP", "Пополнение депозита"),
    (15, "RCDT", "Банк.код: списание"),
    (16, "PMNT", "Банк.код: платёж"),
    (17, "CCRD", "Банк.код: карта"),
    (18, "CAMT_STMT", "ISO 20022: проводка выписки"),
    (19, "CAMT_NTF", "ISO 20022: кредитовое уведомление"),
]

# (event_type_id, event_type_code, event_type_name)
EVENT_TYPES = [
    (1, "LOGIN", "Вход"),
    (2, "LOGOUT", "Выход"),
    (3, "SCREEN_VIEW", "Просмотр экрана"),
    (4, "PAYMENT_INIT", "Инициация платежа"),
    (5, "login_success", "Успешный вход (DBO)"),
    (6, "login_failed", "Неуспешный вход (DBO)"),
    (7, "card_limit_changed", "Изменение лимита карты"),
    (8, "balance_view", "Просмотр баланса"),
    (9, "support_chat_opened", "Открыт чат поддержки"),
    (10, "statement_download", "Скачивание выписки"),
    (11, "payment_created", "Создание платежа"),
    (12, "payment_confirmed", "Подтверждение платежа"),
]

# (appeal_type_id, appeal_type_code, appeal_type_name)
APPEAL_TYPES = [
    (1, "SUPPORT", "Обращение в поддержку"),
    (2, "CLAIM", "Жалоба"),
    (3, "REQUEST", "Заявка"),
    (4, "CONSUMER", "Потребительская жалоба"),
]

# (segment_type_id, segment_type_code, segment_type_name, description)
SEGMENT_TYPES = [
    (1, "ACTIVE", "Активные (регулярное использование услуг)", None),
    (2, "LOW_ACTIVITY", "Малоактивные (редкое использование)", None),
    (3, "NEW", "Новые клиенты", None),
    (4, "DORMANT", "Неактивные (долго без операций)", None),
    (5, "HIGH_VALUE", "Потенциально ценные", None),
]
ACTIVE, LOW_ACTIVITY, NEW, DORMANT, HIGH_VALUE = 1, 2, 3, 4, 5

# The labels mart readers see: (segment_type_id, segment_type_code, segment_type_name)
SEGMENT_LABELS = [
    (0, "UNKNOWN", "Не задан"),
    (1, "ACTIVE", "Активные клиенты (регулярно используют банковские услуги)"),
    (2, "LOW_ACTIVITY", "Малоактивные клиенты (редко используют услуги)"),
    (3, "NEW", "Новые клиенты"),
    (4, "DORMANT", "Неактивные клиенты (нет операций длительное время)"),
    (5, "HIGH_VALUE", "Потенциально ценные клиенты"),
]
UNKNOWN_SEGMENT = ("UNKNOWN", "Не задан")

# name -> (rows, schema)
DICTIONARIES = {
    "source_systems": (
        SOURCE_SYSTEMS,
        "source_system_id smallint, source_system_code string, source_system_name string, description string",
    ),
    "channels": (
        CHANNELS,
        "channel_id smallint, channel_code string, channel_name string, is_digital boolean",
    ),
    "product_types": (
        PRODUCT_TYPES,
        "product_type_id smallint, product_type_code string, product_type_name string",
    ),
    "operation_types": (
        OPERATION_TYPES,
        "operation_type_id smallint, operation_type_code string, operation_type_name string",
    ),
    "event_types": (
        EVENT_TYPES,
        "event_type_id smallint, event_type_code string, event_type_name string",
    ),
    "appeal_types": (
        APPEAL_TYPES,
        "appeal_type_id smallint, appeal_type_code string, appeal_type_name string",
    ),
    "segment_types": (
        SEGMENT_TYPES,
        "segment_type_id smallint, segment_type_code string, segment_type_name string, description string",
    ),
    "segment_labels": (
        SEGMENT_LABELS,
        "segment_type_id int, segment_type_code string, segment_type_name string",
    ),
}


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return f"'{value}'"
    return str(value).lower()


def dictionary(spark: SparkSession, name: str) -> DataFrame:
    """A local relation, so its size is known to the optimizer."""
    rows, schema = DICTIONARIES[name]
    fields = [field.split(" ") for field in schema.split(", ")]
    values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
    casts = ", ".join(f"CAST({c} AS {kind}) AS {c}" for c, kind in fields)
    names = ", ".join(c for c, _ in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS d({names})")
