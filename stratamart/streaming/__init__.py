"""The same loads, fed by a file stream."""
