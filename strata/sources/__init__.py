from strata.sources.tables import (  # noqa: F401
    SCHEMAS,
    clickstream,
    customer_orders,
    read_table,
    table_path,
    user_dimension,
    with_session_columns,
)
