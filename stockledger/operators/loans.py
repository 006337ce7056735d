"""Open balances of goods lent to and borrowed from third parties."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger import vocab
from stockledger.functions.exprs import signed, sum0
from stockledger.operators.ledger import filled_keys, of_family

KEYS = ["Bodega", *vocab.PRODUCT, "Tercero"]


def _balance(ledger: DataFrame, family: str, quantity: str, value: str) -> DataFrame:
    sign = F.col("sign")
    return (
        filled_keys(of_family(ledger, family))
        .groupBy(*KEYS)
        .agg(sum0(signed("Cantidad", sign)).alias(quantity), sum0(signed("ValorTotal", sign)).alias(value))
    )


def lent_balance(ledger: DataFrame) -> DataFrame:
    """Lent less given back, per warehouse, product and third party."""
    return _balance(ledger, "lent", "SaldoPrestamos_realizados", "Saldo_Prestamos_Realizados")


def borrowed_balance(ledger: DataFrame) -> DataFrame:
    """Borrowed less given back, per warehouse, product and third party."""
    return _balance(ledger, "borrowed", "SaldoPrestamos_recibidos", "Saldo_Prestamos_Recibidos")
