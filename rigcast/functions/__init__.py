"""Column-level functions: pure ``Column -> Column`` builders, all JVM-side."""

from rigcast.functions.names import (decode_url_path, file_name, normalise_name,
                                     normalise_names, unit_from_name)
from rigcast.functions.numeric import (abs_mech_power, coerce_double, hyd_power,
                                       mech_power, power_expr)

__all__ = [
    "abs_mech_power", "coerce_double", "decode_url_path", "file_name", "hyd_power",
    "mech_power", "normalise_name", "normalise_names", "power_expr", "unit_from_name",
]
