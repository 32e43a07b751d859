"""Pure ``Column`` helpers.  Nothing here runs a job."""

from reviewlake.functions import jsonfn, numeric, text, timefn  # noqa: F401
