"""SQL for every registered query that SQL can express."""

from oracles import cards, operators
from oracles.facts import EDGE, edge, full

FACT_TABLES = {
    "fact_orders": "fact_orders",
    "fact_daily_sales": "fact_daily",
    "fact_product_sales": "fact_products_sold",
    "fact_refunds": "fact_refunds",
    "fact_customers": "fact_customers",
    "fact_inventory": "fact_inventory",
    "fact_seller": "fact_seller",
    "fact_marketing": "fact_marketing",
    "fact_email_campaigns": "fact_email",
}


def statements() -> dict[str, str]:
    out = {key: full(edge(table, EDGE[table])) for key, table in FACT_TABLES.items()}
    out |= cards.statements()
    out |= operators.statements()
    return out
