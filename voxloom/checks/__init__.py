"""Every operator as a query over the driver's tables, with SQL of its own to compare against."""
