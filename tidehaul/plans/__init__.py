from tidehaul.plans.bulk_load import StagedLoad, bulk_load

__all__ = ["StagedLoad", "bulk_load"]
