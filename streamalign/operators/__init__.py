"""Set-based operators over ordered samples, events, intervals and knots."""
