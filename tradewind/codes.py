"""Code values that appear in the data."""

# They have to equal the codes the upstream systems write.
ORDER_STATUS = {
    "unpaid": "1001",
    "paid": "1002",
    "cancelled": "1003",
    "finished": "1004",
    "refunding": "1005",
    "refunded": "1006",
}
PAYMENT_TYPE = {"alipay": "1101", "wechat": "1102", "union": "1103"}
APPRAISE = {"good": "1201", "medium": "1202", "bad": "1203", "auto": "1204"}

# Weight of one keyword hit by where it was seen; any other source weighs 0.
KEYWORD_WEIGHT = {"SEARCH": 10, "ORDER": 3, "CART": 2, "CLICK": 1}
