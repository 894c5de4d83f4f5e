"""Trip-reliability metrics and an owned data contract, as Spark DataFrame jobs."""

from tripgauge.contract import Contract, ContractAbort

__all__ = ["Contract", "ContractAbort"]
