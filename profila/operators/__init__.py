"""Operators of the device-profiling engine, each a DataFrame → DataFrame
function planned by Catalyst."""
