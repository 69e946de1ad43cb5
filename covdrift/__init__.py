"""Coverage drift: find insurance-coverage changes that matter, with Spark DataFrames."""

from covdrift.params import DrugRule, Messages, Params, ReminderRouting

__all__ = ["DrugRule", "Messages", "Params", "ReminderRouting"]
