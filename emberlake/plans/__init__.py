"""Named queries over the climate model: the catalog (A-J) and the reports."""
