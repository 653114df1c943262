"""Named queries over the driver's tables, each with its SQL restatement where SQL can say it."""
