"""Plans: assembling operators into the warehouse build and checking physical plans."""

from careflow.plans.warehouse import Warehouse, build_warehouse, load_warehouse

__all__ = ["Warehouse", "build_warehouse", "load_warehouse"]
