"""Schemas, keys and rules of the eight input tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.IntegerType()
AMOUNT = T.DecimalType(10, 2)
MOMENT = T.TimestampNTZType()


@dataclass(frozen=True)
class Table:
    """A schema with the rules its rows must keep."""

    schema: T.StructType
    key: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _struct(required: str, **columns: T.DataType) -> T.StructType:
    needed = set(required.split())
    return T.StructType([T.StructField(n, t, n not in needed) for n, t in columns.items()])


# Table names, column names, types and rules of the data model.
TABLES: dict[str, Table] = {
    "customers": Table(
        _struct(
            "customer_id customer_unique_id",
            customer_id=TEXT,
            customer_unique_id=TEXT,
            customer_zip_code_prefix=TEXT,
            customer_city=TEXT,
            customer_state=TEXT,
        ),
        key=("customer_id",),
    ),
    "sellers": Table(
        _struct(
            "seller_id",
            seller_id=TEXT,
            seller_zip_code_prefix=TEXT,
            seller_city=TEXT,
            seller_state=TEXT,
        ),
        key=("seller_id",),
    ),
    "products": Table(
        _struct(
            "product_id",
            product_id=TEXT,
            product_category_name=TEXT,
            product_name_lenght=WHOLE,
            product_description_lenght=WHOLE,
            product_photos_qty=WHOLE,
            product_weight_g=AMOUNT,
            product_length_cm=AMOUNT,
            product_height_cm=AMOUNT,
            product_width_cm=AMOUNT,
        ),
        key=("product_id",),
    ),
    "product_category_name_translation": Table(
        _struct(
            "product_category_name product_category_name_english",
            product_category_name=TEXT,
            product_category_name_english=TEXT,
        ),
        key=("product_category_name",),
    ),
    "orders": Table(
        _struct(
            "order_id customer_id order_status order_purchase_timestamp",
            order_id=TEXT,
            customer_id=TEXT,
            order_status=TEXT,
            order_purchase_timestamp=MOMENT,
            order_approved_at=MOMENT,
            order_delivered_carrier_date=MOMENT,
            order_delivered_customer_date=MOMENT,
            order_estimated_delivery_date=MOMENT,
        ),
        key=("order_id",),
        references={"customer_id": ("customers", "customer_id")},
    ),
    "order_items": Table(
        _struct(
            "order_id order_item_id product_id seller_id price freight_value",
            order_id=TEXT,
            order_item_id=WHOLE,
            product_id=TEXT,
            seller_id=TEXT,
            shipping_limit_date=MOMENT,
            price=AMOUNT,
            freight_value=AMOUNT,
        ),
        key=("order_id", "order_item_id"),
        references={
            "order_id": ("orders", "order_id"),
            "product_id": ("products", "product_id"),
            "seller_id": ("sellers", "seller_id"),
        },
    ),
    "order_payments": Table(
        _struct(
            "order_id payment_sequential payment_type payment_value",
            order_id=TEXT,
            payment_sequential=WHOLE,
            payment_type=TEXT,
            payment_installments=WHOLE,
            payment_value=AMOUNT,
        ),
        key=("order_id", "payment_sequential"),
        references={"order_id": ("orders", "order_id")},
    ),
    "order_reviews": Table(
        _struct(
            "review_id order_id review_score",
            review_id=TEXT,
            order_id=TEXT,
            review_score=WHOLE,
            review_comment_title=TEXT,
            review_comment_message=TEXT,
            review_creation_date=MOMENT,
            review_answer_timestamp=MOMENT,
        ),
        key=("review_id",),
        references={"order_id": ("orders", "order_id")},
        ranges={"review_score": (1, 5)},
    ),
}

# Short names used in row-count reports.
REPORT_NAMES = {
    "customers": "customers",
    "sellers": "sellers",
    "products": "products",
    "product_category_name_translation": "translations",
    "orders": "orders",
    "order_items": "order_items",
    "order_payments": "payments",
    "order_reviews": "reviews",
}

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("customer_unique_id", TEXT),
        T.StructField("nb_commandes", T.LongType()),
        T.StructField("jours_depuis_derniere_commande", T.LongType()),
        T.StructField("valeur_totale", T.DecimalType(18, 2)),
        T.StructField("panier_moyen", T.DoubleType()),
        T.StructField("panier_moyen_par_commande", T.DoubleType()),
        T.StructField("score_moyen_reviews", T.DoubleType()),
        T.StructField("nb_reviews", T.LongType()),
        T.StructField("nb_mauvaises_reviews", T.LongType()),
        T.StructField("pct_mauvaises_reviews", T.DoubleType()),
        T.StructField("nb_categories_distinctes", T.LongType()),
        T.StructField("delai_moyen_inter_commandes", T.DoubleType()),
        T.StructField("tendance_panier", T.DoubleType()),
        T.StructField("rang_par_valeur", T.LongType()),
        T.StructField("mode_paiement_prefere", TEXT),
        T.StructField("nb_moyen_versements", T.DoubleType()),
        T.StructField("est_churne", T.IntegerType()),
        T.StructField("segment_client", TEXT),
    ]
)
FEATURE_COLUMNS = FEATURE_SCHEMA.fieldNames()
