"""Error classes and the good / quarantine split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error class and the opening words of its messages.  Two classes
# and the first put the name of a service before these words.
ERROR_MESSAGES = {
    "response": "服务端返回异常: ",
    "network": "网络错误: ",
    "http_build": "Http构造错误: ",
    "url_parse": "str 转 url错误: ",
    "header_value": "Header Value 格式错误: ",
    "json": "serde json 转换错误: ",
    "header_text": "HeaderValue转换为str错误: ",
    "hmac_key": "Hmac Sha1 格式错误: ",
    "region": "endpoint查找region信息错误: ",
    "arrow": "发送arrow数据失败: ",
}
NAMED_SERVICE = {"response", "region", "arrow"}
OTHER = "other"


def error_class(message: Column) -> Column:
    """Class of a message by its opening words; ``other`` if it has none of them."""

    def opens(name: str) -> Column:
        words = ERROR_MESSAGES[name]
        if name in NAMED_SERVICE:
            return message.rlike(f"^(?:[A-Za-z]+ ){{0,2}}{words}")
        return message.startswith(words)

    chain = reduce(lambda c, name: c.when(opens(name), name), ERROR_MESSAGES, F)
    return chain.otherwise(OTHER)


def classify_errors(df: DataFrame, msg: str) -> DataFrame:
    """``(error_class, n)``."""
    return df.groupBy(error_class(F.col(msg)).alias("error_class")).agg(
        F.count(F.lit(1)).alias("n")
    )


def first_error(checks: dict[str, Column]) -> Column:
    """Name of the first check that does not hold, or null."""
    return F.coalesce(
        *[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in checks.items()]
    )


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without an error (the column dropped), and the others with it."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())
