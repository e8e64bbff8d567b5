"""Event rules: which raw events feed which daily counter."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ActivityRules:
    """Column names and membership lists of one log source.

    ``event_classes`` maps a counter to the event ids it counts; an id may feed several
    counters. ``alert_columns`` maps an alert counter to the column that holds the alert text.
    """

    event_classes: Mapping[str, tuple[str, ...]]
    alert_columns: Mapping[str, str]
    shell_ids: tuple[str, ...]
    shell_pattern: str
    file_ids: tuple[str, ...]
    file_logon_type: str
    script_pattern: str
    event_id: str = "windowseventid"
    process: str = "windowsprocessname"
    logon_type: str = "windowslogontype"
    alert_flag: str = "is_alert"
    script_counter: str = "ps_count"
    counters: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        names = (*self.alert_columns, *self.event_classes, self.script_counter)
        object.__setattr__(self, "counters", names)

    def in_ids(self, ids: tuple[str, ...]) -> Column:
        return F.col(self.event_id).isin(*ids)

    def script_activity(self) -> Column:
        """A shell was started, or a script file was touched by a file logon."""
        process = F.col(self.process)
        shell = self.in_ids(self.shell_ids) & process.rlike(self.shell_pattern)
        touched = (
            self.in_ids(self.file_ids)
            & (F.col(self.logon_type) == self.file_logon_type)
            & process.rlike(self.script_pattern)
        )
        return shell | touched

    def alerting(self, text_column: str) -> Column:
        text = F.col(text_column)
        return F.col(self.alert_flag) & text.isNotNull() & (text != "")

    def flags(self) -> list[Column]:
        """One 0/1 integer column per counter, evaluated once per raw event."""

        def as_int(condition: Column, name: str) -> Column:
            return F.when(condition, 1).otherwise(0).alias(name)

        alerts = [as_int(self.alerting(text), name) for name, text in self.alert_columns.items()]
        classes = [as_int(self.in_ids(ids), name) for name, ids in self.event_classes.items()]
        return [*alerts, *classes, as_int(self.script_activity(), self.script_counter)]


# Event ids and patterns of the operating-system log source. The script suffixes
# carry a trailing dot, so "a.ps1" alone does not match while "a.ps1.bak" does.
OS_LOG_RULES = ActivityRules(
    event_classes={
        "logins_count": ("4624", "4634"),
        "fileactivity_count": ("4656", "4659"),
        "failedlogin_count": ("4625", "4634"),
        "other_scripts_count": ("4688",),
        "pri_count": ("4672", "4707"),
    },
    alert_columns={"is_nu_alert_count": "alerts_nu", "is_ne_alert_count": "alerts_ne"},
    shell_ids=("4688",),
    shell_pattern=r"powershell\.exe|powershell_ise\.exe|pwsh\.exe",
    file_ids=("4656", "4663"),
    file_logon_type="File",
    script_pattern=r"\.ps1\.|\.psd1\.|\.psm1\.|\.ps1xm1\.|\.clixml\.|\.psc1\.|\.pssc\.",
)

# The six activity counters every profile model is trained on.
PROFILE_COUNTERS = (
    "failedlogin_count",
    "fileactivity_count",
    "logins_count",
    "other_scripts_count",
    "pri_count",
    "ps_count",
)

# Which raw column names the actor of each profile type.
ACTORS = {"user": "devicehostname", "entity": "deviceaddress"}

DAY_COLS = ("y", "m", "d")
GROUP_COLS = ("type", "y", "m", "d")
