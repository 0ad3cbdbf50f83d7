import math

import pytest
from pyspark.sql import functions as F

from shoplens.functions import actions as FA
from shoplens.functions import spans as FS
from shoplens.functions import text as FT
from shoplens.functions import vectors as FV


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def vec(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_ema_blends_then_normalises(spark):
    got = one(spark, FV.ema_step(vec(1, 0, 0), vec(0, 1, 0), F.lit(0.3)))
    assert got == pytest.approx([0.919145, 0.393919, 0], abs=1e-6)


def test_first_vector_is_normalised_whatever_the_rate(spark):
    n = math.sqrt(0.14)
    none = F.lit(None).cast("array<double>")
    for rate in (0.0, 0.5):
        assert one(spark, FV.ema_step(none, vec(0.1, 0.2, 0.3), F.lit(rate))) == pytest.approx([0.1 / n, 0.2 / n, 0.3 / n])


def test_rate_zero_keeps_the_vector_and_zero_vector_stays(spark):
    assert one(spark, FV.ema_step(vec(3, 4), vec(1, 0), F.lit(0.0))) == [3, 4]
    assert one(spark, FV.l2_normalize(vec(0, 0))) == [0, 0]


def test_knn_score_range(spark):
    assert one(spark, FV.knn_score(vec(1, 0), vec(2, 0))) == 1
    assert one(spark, FV.knn_score(vec(1, 0), vec(-1, 0))) == 0
    assert one(spark, FV.knn_score(vec(1, 0), vec(0, 3))) == 0.5


@pytest.mark.parametrize("action,rate", [("purchase", .5), ("ADD_TO_CART", .3), ("click", .3), ("SEARCH", .2), ("VIEW", .1),
                                         ("wishlist", .1), ("signup", 0), (None, 0)])
def test_action_alpha(spark, action, rate):
    assert one(spark, FA.action_alpha(F.lit(action).cast("string"))) == rate


@pytest.mark.parametrize("prev,cur,fires", [(100, 90, True), (100, 90.5, False), (0, 5, False), (100, -1, False),
                                            (None, 5, False), (5, None, False), (90, 100, False)])
def test_price_drop(spark, prev, cur, fires):
    p, c = (F.lit(None if x is None else float(x)).cast("float") for x in (prev, cur))
    assert one(spark, FA.is_price_drop(p, c)) is fires


def test_drop_truncates(spark):
    assert one(spark, FA.drop_percentage(F.lit(1000.0).cast("float"), F.lit(893.0).cast("float"))) == 10
    assert one(spark, FA.drop_percentage(F.lit(100.0).cast("float"), F.lit(109.9).cast("float"))) == -9


@pytest.mark.parametrize("prev,cur,back", [(0, 1, True), (0, 0, False), (1, 5, False), (None, 5, False), (0, None, False)])
def test_restock(spark, prev, cur, back):
    assert one(spark, FA.is_restock(F.lit(prev).cast("int"), F.lit(cur).cast("int"))) is back


def test_notification_day_changes_at_fifteen_utc(spark):
    days = [str(one(spark, FA.notification_day(F.lit(t).cast("timestamp")))) for t in
            ("2024-03-01 14:59:59", "2024-03-01 15:00:00")]
    assert days == ["2024-03-01", "2024-03-02"]


def test_log_times(spark):
    for text in ("2024-01-02T03:04:05.678+09:00", "2024-01-01T18:04:05.678Z"):
        assert str(one(spark, FA.parse_log_time(F.lit(text)).cast("string"))) == "2024-01-01 18:04:05.678"
    assert one(spark, FA.parse_log_time(F.lit("2024-01-02T03:04:05+09:00")).cast("string")) == "2024-01-01 18:04:05"
    assert one(spark, FA.parse_log_time(F.lit("yesterday"))) is None


def test_texts(spark):
    assert one(spark, FT.price_drop_body(F.lit("Mug"), F.lit(12))) == "Mug이(가) 12% 할인 중입니다!"
    assert one(spark, FT.back_in_stock_body(F.lit(None).cast("string"))) == "상품이(가) 다시 입고되었습니다!"
    assert one(spark, FT.price_drop_data(F.lit(59000.0), F.lit(49000.5), F.lit(16))) == {
        "previousPrice": "59000.0", "currentPrice": "49000.5", "dropPercentage": "16"}
    assert one(spark, FT.product_key(F.lit("ELECTRONICS"), F.lit(7))) == "PROD-ELE-00007"
    assert one(spark, FT.product_key(F.lit("HOME"), F.lit(1234567))) == "PROD-HOM-1234567"
    assert one(spark, FT.user_key(F.lit(42))) == "USER-000042"


def test_span_predicates(spark):
    def tags(*pairs):
        return F.array(*[F.struct(F.lit(k).alias("key"), F.lit("bool" if k == "error" else "string").alias("type"), F.lit(v).alias("value")) for k, v in pairs])

    assert one(spark, FS.span_has_error(tags(("error", "true")))) is True
    assert one(spark, FS.span_has_error(tags(("otel.status_code", "ERROR")))) is True
    assert one(spark, FS.span_has_error(tags(("error", "false"), ("x", "ERROR")))) is False
    assert one(spark, FS.span_is_dlq(F.lit("X.DLQ"), tags(("a", "b")))) is True
    assert one(spark, FS.span_is_dlq(F.lit("send"), tags(("messaging.destination.name", "a.dlq")))) is True
    assert one(spark, FS.span_is_dlq(F.lit("send"), tags(("other", "a.dlq")))) is False
    assert one(spark, FS.tag_value(tags(("b", "1"), ("a", "2")), "a", "b")) == "1"


def test_enum_or_default(spark):
    assert one(spark, FA.enum_or_default(F.lit("X"), ["A"], "A")) == "A"
    assert one(spark, FA.enum_or_default(F.lit(None).cast("string"), ["A", "B"], "B")) == "B"
