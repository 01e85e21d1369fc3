"""Rows for the model fixture, and reading results by key."""

from retinue.sources.schemas import TABLES


class Shop:
    """Collects rows for the model fixture, one call per business event."""

    def __init__(self):
        self.rows = {name: [] for name in TABLES}
        self._accounts = {}

    def product(self, product_id, category=None):
        self.rows["products"].append(
            {"product_id": product_id, "product_category_name": category}
        )
        return self

    def order(self, order_id, person, at, items=(), payments=(), scores=(), status="delivered"):
        """``items``: (product, price, freight); ``payments``: (type, instalments, value)."""
        account = f"acc-{order_id}"
        self.rows["customers"].append({"customer_id": account, "customer_unique_id": person})
        self.rows["orders"].append(
            {
                "order_id": order_id,
                "customer_id": account,
                "order_status": status,
                "order_purchase_timestamp": at,
            }
        )
        for n, (product, price, freight) in enumerate(items, 1):
            self.rows["order_items"].append(
                {
                    "order_id": order_id,
                    "order_item_id": n,
                    "product_id": product,
                    "seller_id": "s",
                    "price": price,
                    "freight_value": freight,
                }
            )
        for n, (kind, instalments, value) in enumerate(payments, 1):
            self.rows["order_payments"].append(
                {
                    "order_id": order_id,
                    "payment_sequential": n,
                    "payment_type": kind,
                    "payment_installments": instalments,
                    "payment_value": value,
                }
            )
        for n, score in enumerate(scores, 1):
            self.rows["order_reviews"].append(
                {"review_id": f"r-{order_id}-{n}", "order_id": order_id, "review_score": score}
            )
        return self


def rows_by(df, key):
    return {row[key]: row for row in df.collect()}
