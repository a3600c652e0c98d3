"""Small inputs built from the boundary rows documented in FIXTURES.md."""

from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def epoch(s: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(seconds=s)


# Login log rows whose result depends on event time vs arrival order.
LOGIN_KEY_LINES = [
    "1035,83.149.9.216,fail,1558430842",
    "1035,83.149.24.26,success,1558430844",
    "1035,83.149.9.216,fail,1558430843",
]

# Order log boundary rows: never paid (34730: create + modify), pay in the
# same second (34747), pays 1,038 s and 1,072 s after create (34756, 34767;
# limit 900 s), pay without create (34768).
ORDER_KEY_LINES = [
    "34730,create,,1558430843",
    "34730,modify,3hu3k2432,1558430845",
    "34747,create,,1558430893",
    "34747,pay,329d09f9f,1558430893",
    "34756,create,,1558430913",
    "34756,pay,9032n4fd2,1558431951",
    "34767,create,,1558430949",
    "34767,pay,sdafen9932,1558432021",
    "34768,pay,88snrn932,1558430950",
]

# The five pay/receipt pairs within 5 s: (order, tx_id, pay time, receipt time).
TX_PAIRS = [
    (34729, "sd76f87d6", 1558430844, 1558430847),
    (34730, "3hu3k2432", 1558430845, 1558430848),
    (34734, "435kjb45d", 1558430863, 1558430859),
    (34746, "3243hr9h9", 1558430895, 1558430892),
    (34747, "329d09f9f", 1558430893, 1558430893),
]

AD_CLICK_SAMPLE = "543462,1715,beijing,beijing,1511658000"
