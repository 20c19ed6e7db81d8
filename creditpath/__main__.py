from .plans.medallion import main

main()
