"""The reconciliation jobs and the registry of named queries."""

from idbridge.plans.pipelines import AssociationRepair, TicketOrphans, TransactionOrphans, UserMapping

__all__ = ["AssociationRepair", "TicketOrphans", "TransactionOrphans", "UserMapping"]
